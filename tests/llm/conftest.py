import pytest
from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)).translate(str.maketrans("0123456789", "qwertyuiop")) for _ in range(n))


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    *[T.StructField(c, T.StringType()) for c in ("name", "h", "n", "rid2", "level", "root", "size", "kept", "z", "take", "m", "words", "x")]])


def rows(*texts):
    """Rows (id, text, lang, source, n_chars, clashing columns) from texts or (id, text[, source])."""
    out = []
    for i, t in enumerate(texts):
        t = t if isinstance(t, tuple) else (i, t)
        out.append((t[0], t[1], "en", t[2] if len(t) > 2 else "s", None, *["clash"] * 13))
    return out


@pytest.fixture
def stored(spark, tmp_path):
    """A stored table of documents, as the operators get it."""
    def make(data, name="documents", parts=3):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(data, SCHEMA).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)
    return make


EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "One"), (4, "One"), (5, "one"), (None, "ONE"), (6, "é É"), (7, "É É"),
        (8, prose(1, 4000)), (9, prose(1, 4000)), (None, None)]
