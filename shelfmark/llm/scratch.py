"""Tables that cut lineage: written once to the shared folder and read back."""

from ..session import shared_folder


def stored(df, label):
    """`df` written as Parquet to the cluster's shared folder, and read again.

    Survives the loss of executors, unlike a local checkpoint. The folder is left to the owner of
    `spark.checkpoint.dir`, since the lazy result may be read at any later time.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
