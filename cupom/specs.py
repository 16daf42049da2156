"""Dataset registry: partition keys, grains, file formats and the gold table contracts.

These names are the public data model; they are fixed values shared with the upstream feeds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DAY, MONTH, SNAPSHOT = "day", "month", "snapshot"
SNAPSHOT_VALUE = "1"


@dataclass(frozen=True)
class PartitionSpec:
    dataset: str
    partition_key: str
    grain: str
    bronze_format: str
    mode: str  # "missing_dates" or "run_always"
    date_columns: tuple[str, ...] = ()

    @property
    def partition_column(self) -> str:
        # Own directory key: a bronze file may carry a data column with the feed's key name
        # (PTAX has ``data``), and Spark would hide it behind the partition value.
        return f"p_{self.partition_key}"


# Dataset → (partition key, grain, bronze format, date mode, date column candidates).
SPECS: dict[str, PartitionSpec] = {
    s.dataset: s
    for s in (
        PartitionSpec("mercado_secundario", "data", DAY, "json", "missing_dates"),
        PartitionSpec("liquidacoes_mercado", "data", DAY, "parquet", "missing_dates", ("DATA MOV", "data", "DATA", "Data Negociação", "data_negociacao")),
        PartitionSpec("ajustes_bmf", "data", DAY, "parquet", "missing_dates", ("RptDt", "data_referencia")),
        PartitionSpec("leiloes", "data", DAY, "json", "missing_dates", ("dataLeilao", "data_leilao", "data_referencia")),
        PartitionSpec("ipca_indice", "reference_month", MONTH, "parquet", "run_always", ("D2C", "DATA_CODIGO", "DATA", "ref_month")),
        PartitionSpec("projecoes", "reference_month", MONTH, "json", "run_always"),
        PartitionSpec("feriados", "snapshot", SNAPSHOT, "parquet", "run_always"),
        PartitionSpec("cdi", "data", DAY, "parquet", "missing_dates", ("data_referencia", "data")),
        PartitionSpec("ptax", "data", DAY, "parquet", "missing_dates", ("data",)),
        PartitionSpec("vna", "data", DAY, "json", "missing_dates", ("data_referencia", "data", "dt_referencia")),
    )
}

MONTHLY_DATASETS = frozenset({"ipca_indice", "projecoes"})


def get_spec(dataset: str) -> PartitionSpec:
    try:
        return SPECS[dataset]
    except KeyError:
        raise KeyError(f"unknown dataset {dataset!r}; known: {sorted(SPECS)}") from None


@dataclass(frozen=True)
class GoldTable:
    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    date_column: str | None
    types: dict[str, T.DataType] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    checks: dict[str, tuple] = field(default_factory=dict)  # column -> allowed values

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.types.get(c, T.StringType()), True) for c in self.columns])


_D, _S, _F, _L, _I = T.DateType(), T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

# The status domain of bonds.
BOND_STATUS = ("ATIVO", "INATIVO", "SUSPENSO", "CANCELADO", "RESGATADO")
STATUS_DEFAULT = "ATIVO"

GOLD: dict[str, GoldTable] = {
    t.name: t
    for t in (
        GoldTable("FERIADOS", ("data",), ("data",), "data", {"data": _D}),
        GoldTable("CDI", ("data_referencia", "cdi"), ("data_referencia",), "data_referencia",
                  {"data_referencia": _D, "cdi": _F}, not_null=("cdi",)),
        GoldTable("PTAX", ("data_referencia", "ptax_compra", "ptax_venda"), ("data_referencia",), "data_referencia",
                  {"data_referencia": _D, "ptax_compra": _F, "ptax_venda": _F}),
        GoldTable("VNA", ("data_referencia", "codigo_selic", "tipo_correcao", "index", "data_validade", "vna",
                          "vna_ajustado"), ("data_referencia", "codigo_selic"), "data_referencia",
                  {"data_referencia": _D, "codigo_selic": _L, "index": _F, "data_validade": _D, "vna": _F,
                   "vna_ajustado": _F},
                  not_null=("data_referencia", "codigo_selic", "tipo_correcao", "index", "data_validade", "vna")),
        GoldTable("IPCA_DICT", ("data_referencia", "ultimo_mes_ipca", "ref_month_atual", "ref_month_anterior",
                                "indice_ipca_data_base", "indice_ipca_fechado_atual", "indice_ipca_fechado_anterior",
                                "var_ipca_atual", "var_ipca_ant", "ipca_proj", "ipca_usado", "usa_fechado",
                                "data_coleta_referencia", "ipca_proj_data_coleta", "inicio_mes_ipca", "fim_mes_ipca"),
                  ("data_referencia",), "data_referencia",
                  {"data_referencia": _D, "ref_month_atual": _D, "ref_month_anterior": _D,
                   "indice_ipca_data_base": _F, "indice_ipca_fechado_atual": _F, "indice_ipca_fechado_anterior": _F,
                   "var_ipca_atual": _F, "var_ipca_ant": _F, "ipca_proj": _F, "ipca_usado": _F, "usa_fechado": _I,
                   "data_coleta_referencia": _D, "ipca_proj_data_coleta": _D, "inicio_mes_ipca": _D,
                   "fim_mes_ipca": _D},
                  not_null=("usa_fechado",), checks={"usa_fechado": (0, 1)}),
        GoldTable("TITULOS_PUBLICOS", ("tipo_titulo", "data_vencimento", "expressao", "data_base", "codigo_selic",
                                       "codigo_isin", "status"), ("tipo_titulo", "data_vencimento"), None,
                  {"data_vencimento": _D, "data_base": _D}, checks={"status": BOND_STATUS}),
        GoldTable("MERCADO_SECUNDARIO", ("tipo_titulo", "data_vencimento", "data_referencia", "taxa_anbima",
                                         "intervalo_min_d0", "intervalo_max_d0", "intervalo_min_d1",
                                         "intervalo_max_d1", "pu", "expressao", "data_base", "codigo_selic",
                                         "codigo_isin", "taxa_compra", "taxa_venda", "desvio_padrao", "status"),
                  ("tipo_titulo", "data_vencimento", "data_referencia"), "data_referencia",
                  {"data_vencimento": _D, "data_referencia": _D, "taxa_anbima": _F, "intervalo_min_d0": _F,
                   "intervalo_max_d0": _F, "intervalo_min_d1": _F, "intervalo_max_d1": _F, "pu": _F,
                   "data_base": _D, "taxa_compra": _F, "taxa_venda": _F, "desvio_padrao": _F},
                  checks={"status": BOND_STATUS}),
        GoldTable("LIQUIDACOES_MERCADO", ("tipo_titulo", "data_vencimento", "data_referencia", "qtd_operacoes",
                                          "qtd_titulos", "pu_medio", "expressao", "data_base", "codigo_selic",
                                          "codigo_isin", "status"),
                  ("tipo_titulo", "data_vencimento", "data_referencia"), "data_referencia",
                  {"data_vencimento": _D, "data_referencia": _D, "qtd_operacoes": _L, "qtd_titulos": _F,
                   "pu_medio": _F, "data_base": _D}, checks={"status": BOND_STATUS}),
        GoldTable("LEILOES", ("numero_edital", "tipo_titulo", "data_vencimento", "data_referencia", "oferta",
                              "quantidade_aceita", "percentual_corte", "oferta_segunda_volta", "financeiro_aceito",
                              "financeiro_aceito_segunda_volta", "quantidade_aceita_segunda_volta", "pu_medio",
                              "taxa_media"),
                  ("tipo_titulo", "data_vencimento", "data_referencia", "numero_edital"), "data_referencia",
                  {"numero_edital": _L, "data_vencimento": _D, "data_referencia": _D, "oferta": _L,
                   "quantidade_aceita": _F, "percentual_corte": _F, "oferta_segunda_volta": _F,
                   "financeiro_aceito": _F, "financeiro_aceito_segunda_volta": _F,
                   "quantidade_aceita_segunda_volta": _F, "pu_medio": _F, "taxa_media": _F}),
        GoldTable("CONTRATOS_BMF", ("ticker", "codigo_isin", "data_vencimento"), ("ticker",), None,
                  {"data_vencimento": _D}, not_null=("data_vencimento",)),
        GoldTable("AJUSTES_BMF", ("ticker", "data_referencia", "taxa_ajuste", "quantidade_ajuste"),
                  ("ticker", "data_referencia"), "data_referencia",
                  {"data_referencia": _D, "taxa_ajuste": _F, "quantidade_ajuste": _F}),
    )
}

# Gold builder → tables it writes (the dimension first).
BUILDER_TABLES: dict[str, tuple[str, ...]] = {
    "feriados": ("FERIADOS",),
    "cdi": ("CDI",),
    "ptax": ("PTAX",),
    "vna": ("VNA",),
    "ipca_dict": ("IPCA_DICT",),
    "mercado_secundario": ("TITULOS_PUBLICOS", "MERCADO_SECUNDARIO"),
    "liquidacoes_mercado": ("TITULOS_PUBLICOS", "LIQUIDACOES_MERCADO"),
    "leiloes": ("TITULOS_PUBLICOS", "LEILOES"),
    "bmf": ("CONTRATOS_BMF", "AJUSTES_BMF"),
}

# Gold builder → silver inputs. Order matters: holidays first, the inflation builder late.
BUILDER_INPUTS: dict[str, tuple[str, ...]] = {
    "feriados": ("feriados",),
    "cdi": ("cdi",),
    "ptax": ("ptax",),
    "mercado_secundario": ("mercado_secundario",),
    "liquidacoes_mercado": ("liquidacoes_mercado",),
    "leiloes": ("leiloes",),
    "bmf": ("ajustes_bmf",),
    "ipca_dict": ("ipca_indice", "projecoes"),
    "vna": ("vna",),
}


def get_gold(name: str) -> GoldTable:
    return GOLD[name.upper()]
