"""Session settings the jobs are meant to run with.

Partition counts and memory belong to the cluster and are not set here: choose
``spark.sql.shuffle.partitions`` for partitions of 100 to 200 MB of the largest
shuffle (the quotes of a run), and AQE gathers those of the smaller ones.
"""

from pyspark.sql import SparkSession

SETTINGS = {
    # splits hot join partitions, gathers small ones, picks joins by true sizes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The enriching job has more generated classes than the default cache holds
    # (100), so each of its tasks would compile them anew.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Tables by date have thousands of folders, and by default each is listed by a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
