import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd_documents(spark, texts=None):
    """Nulls in any column, empty and repeated rows, ties, and extra columns whose names an operator might use itself."""
    texts = texts or [None, "", "  \n ", "one", "a b c d e f g h", "a b c d e f g h", "Ünïcode ﬁ İ 😀 x" * 3, "z " * 3000]
    rows = [(i if i != 3 else None, t, None, None if i % 3 == 0 else f"s{i % 3}", None, i, "k") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], rows[0]]
    return spark.createDataFrame(rows, DOCS + ", size int, row string")


def sql(query, **frames):
    import duckdb

    con = duckdb.connect()
    for k, v in frames.items():
        con.register(k, v)
    out = con.sql(query).df()
    return out.astype({c: "float64" for c, kind in out.dtypes.items() if str(kind) == "Int64"})  # as Spark's toPandas has whole numbers with nulls


def same(a, b):
    """Equal rows in any order, by column name."""
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)

    def canon(f):
        out = []
        for row in f[cols].itertuples(index=False):
            out.append(tuple(None if x is None or x != x else (round(float(x), 9) if isinstance(x, float) or hasattr(x, "dtype") else x) for x in row))
        return sorted(out, key=repr)

    x, y = canon(a), canon(b)
    assert [tuple(map(str, r)) for r in x] == [tuple(map(str, r)) for r in y]
