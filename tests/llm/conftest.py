import os
import re

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})

#: Columns whose names the operators use themselves.
CLASH = ("score double, shard int, slot long, h long, hash long, block int, key string, spoken boolean, lang_pred string, "
         "predicted int, spans string, label string, rank int, tries string")
LONG = "Many words of a long text go on. " * 9000


def words_of(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from sensorlake.llm.common import ship
    ship(spark)


@pytest.fixture()
def documents(spark):
    """Documents of (doc_id, text[, lang]) with further columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) + (None,) * 14 for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + CLASH)
    return make


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "labels"):
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def same(df, con, sql):
    """The rows of a DataFrame and of a SQL query are equal, in any order."""
    cols = sorted(df.columns)
    res = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({sql})")
    key = lambda rows: sorted(map(repr, [tuple(r) for r in rows]))
    assert key(df.select(*cols).collect()) == key(res.fetchall())
