"""Column names as they are, dots and backquotes included."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")
