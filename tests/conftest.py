import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def local_session():
    from pyspark.sql import SparkSession

    from corpusloom.session import configure

    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return local_session()
