import os

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from rows, over several partitions."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def clashing():
    """Adds columns named like those that operators add themselves."""
    def add(df, *names):
        return df.withColumns({n: F.lit("own") for n in names if n not in df.columns})

    return add


@pytest.fixture(scope="session")
def tables(tmp_path_factory):
    """Writes tables under a folder as the queries read them."""
    def write(**frames):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, df in frames.items():
            df.write.parquet(os.path.join(folder, f"{name}.parquet"))
        return folder

    return write
