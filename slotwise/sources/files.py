"""Inventory of a folder of raw files, from file metadata only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators.enrich import stack
from slotwise.operators.quality import fact, profile_facts

# The name for a file without suffix, and the ignored marker.
NO_SUFFIX = "desconocido"
IGNORED = ".gitkeep"


def file_index(spark: SparkSession, folder: str) -> DataFrame:
    """Relative path, format and size in MB of every file under the folder, by path.

    Files come from a listing, names with a leading dot or underscore included; none is opened.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listing = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    root = f"{path.toUri().getPath().rstrip('/')}/"
    rows = []
    while listing.hasNext():
        found = listing.next()
        full = found.getPath().toUri().getPath()
        rows.append((full.split(root, 1)[-1], full.rsplit("/", 1)[-1], found.getLen()))
    listed = spark.createDataFrame(rows, "ruta_relativa string, nombre string, bytes long")
    # A suffix needs a name before its dot.
    suffix = F.lower(F.regexp_extract("nombre", r"^.+\.([^.]+)$", 1))
    return (
        listed.filter(F.col("nombre") != IGNORED)
        .select(
            "ruta_relativa",
            F.when(suffix == "", NO_SUFFIX).otherwise(suffix).alias("formato"),
            F.round(F.col("bytes") / (1024 * 1024), 4).alias("tamano_mb"),
        )
        .orderBy("ruta_relativa")
    )


def profile_csv_sample(spark: SparkSession, folder: str, max_files: int = 2, max_rows: int = 20) -> DataFrame:
    """Facts on the first rows of the first CSV files, each file on its own.

    Both bounds are the feature: this is a look at the raw files before anything is read in full.
    """
    picked = [
        r["ruta_relativa"]
        for r in file_index(spark, folder).filter(F.lower("ruta_relativa").endswith(".csv")).limit(max_files).collect()
    ]
    head = spark.range(1).select(*fact("muestra", "archivos_inspeccionados", F.lit(len(picked))))
    if not picked:
        return head.unionByName(
            spark.range(1).select(*fact("muestra", "advertencia", F.lit("sin archivos csv para perfilar")))
        )
    parts = [head]
    for relative in picked:
        rows = spark.read.csv(f"{folder.rstrip('/')}/{relative}", header=True).limit(max_rows)
        parts.append(profile_facts(rows, relative))
    return stack(parts)
