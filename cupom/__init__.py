"""cupom — a Spark-native fixed-income data lake: landed feeds → bronze → silver → gold tables,
the gold read API and the incremental / refresh jobs, all as DataFrame plans."""

__version__ = "0.1.0"
