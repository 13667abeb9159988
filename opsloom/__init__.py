"""Operations analytics on event and appointment tables, as Spark DataFrame operators."""

__version__ = "0.1.0"
