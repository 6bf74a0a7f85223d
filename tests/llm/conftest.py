import pytest
from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash long, bucket int, node string, __row int"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return session


def words(n, seed=0):
    return " ".join(f"w{(i * 7919 + seed * 104729) % 100003}" for i in range(n))


@pytest.fixture(scope="session")
def texts():
    """Ties, repeats, nulls, empty and long texts; ids with gaps; many documents share one passage."""
    shared, long = words(40, 9), words(6000, 3)
    rows = [(1, "Hello world"), (2, "hello WORLD"), (3, None), (4, ""), (5, " \t\n"), (6, "a"), (7, long), (8, long.upper()), (9, long + " tail")]
    rows += [(20 + i, f"{words(30, i)} {shared} {words(25, 100 + i)}") for i in range(30)]
    base = words(120, 5).split()
    rows += [(100 + i, " ".join(base[:4 * i] + [f"x{i}"] + base[4 * i + 1:])) for i in range(20)]
    rows += [(200, "na " * 400), (201, "na " * 400), (202, "é€ß" * 60 + " <|endoftext|>  two"), (203, "é€ß" * 60)]
    rows += [(210 + i, words(5 + i, 50)) for i in range(12)]
    rows += [(230, "I AM !!! 100% $$$ \n same line\nsame line\nsame line")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, None, "s", None, 1, 2, "n", 3) for i, t in texts], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_ids(spark):
    return spark.createDataFrame([(None, t, None, None, None, None, None, None, None) for t in ("same text here", "same text here", None, "")], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(7, 1, 0), (8, 1, 0), (100, 1, 0), (200, 0, 0), (230, 0, 1), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
