"""Array arithmetic kept inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(c: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(c, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    )


def l2_normalized(c: Column | str) -> Column:
    """Unit-length copy; a zero vector is returned as it is."""
    norm = l2_norm(c)
    return F.transform(c, lambda x: F.when(norm > 0, x / norm).otherwise(x.cast("double")))
