"""Seeds: small curated CSV lists shipped with the package.

A packaged list reaches the cluster with the package: its text becomes a
text frame that ``from_csv`` parses with the declared schema.  A list kept on shared storage is read from its path the same way.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas
from kestrel.session import work_dir


CORRUPT = "_corrupt_record"


def read_seed(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """A CSV list with its declared schema, and in ``bad_line`` the text of
    a line that does not fit it (too many or too few fields, a value of another type); the
    columns of such a line are null."""
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
            .option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    bad = F.col(CORRUPT).isNotNull()
    return rows.select(*[F.when(~bad, F.col(c)).alias(c) for c in schema.fieldNames()], F.col(CORRUPT).alias("bad_line"))


def land_domains(spark: SparkSession, customers: DataFrame, path: str | None = None) -> str:
    """Write a seed of the domains in the customers' addresses; the addresses without an '@' of
    every hundredth customer stand in it as lines with a field too many."""
    out = path or work_dir(spark, "seed")
    email = F.col("email")
    domains = customers.where(email.contains("@")).select(F.split_part(email, F.lit("@"), F.lit(2)).alias("valid_domain"))
    broken = customers.where(~email.contains("@") & (F.col("customer_id") % 100 == 3)).select(
        F.concat(email, F.lit(","), F.col("customer_id").cast("string")).alias("valid_domain"))
    domains.distinct().unionByName(broken).write.mode("overwrite").text(out)      # no header, no quotes
    return out


def valid_domains(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Accepted e-mail domains (``valid_domain``)."""
    reader = spark.read.schema(schemas.VALID_DOMAINS).option("header", True)
    if path is not None:
        return reader.csv(path)
    text = resources.files("kestrel.sources").joinpath("seeds", "valid_domains.csv").read_text()
    lines = spark.createDataFrame([(line,) for line in text.splitlines()[1:]], "value string")
    return lines.select(F.from_csv("value", "valid_domain string").alias("r")).select("r.valid_domain")
