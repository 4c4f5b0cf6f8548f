import random

import pytest

from rhapsode.llm.linedup import delete_runs, repeated_runs
from rhapsode.llm.queries import SQL

from .helpers import documents, odd_documents, same, sql


def brute(rows, m=1):
    """rows: (doc_id, text) in order; the maximal runs of m lines or more that occur earlier, from all pairs of lines: (row, line, n, first row, first line)."""
    lines = [[(i, x.strip(" \t\r\x0b\x0c")) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\r\x0b\x0c")] for _, t in rows]
    places = [(r, k) for r in range(len(rows)) for k in range(len(lines[r]))]
    out, reach = [], {}
    for p, (r, k) in enumerate(places):
        best = (0, 0, 0)
        for q, j in places[:p]:
            n = 0
            while k + n < len(lines[r]) and j + n < len(lines[q]) and lines[r][k + n][1] == lines[q][j + n][1]:
                n += 1
            best = max(best, (n, -q, -j))
        n, q, j = best[0], -best[1], -best[2]
        if n >= m and k + n > reach.get(r, 0):
            out.append((r, lines[r][k][0], n, q, lines[q][j][0]))
            reach[r] = k + n
    return out


def test_equals_sql(spark):
    docs = documents(spark)
    same(repeated_runs(docs).toPandas(), sql(SQL["op2_line_dedup"], documents=docs.toPandas()))


def runs(got):
    return sorted((r["doc_id"], r["line_from"], r["n_lines"], r["first_doc_id"], r["first_line"]) for r in got)


def test_each_run_has_its_own_source(spark):
    rows = [(1, "a1\na2\nxx"), (2, "b1\r\nb2\r\n\r\nyy"), (3, "a1\na2\nb1\nb2"), (4, "a2\nb1"), (5, "yy")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(3, 0, 2, 1, 0), (3, 2, 2, 2, 0), (4, 0, 2, 3, 1), (5, 0, 1, 2, 3)]
    assert runs(repeated_runs(df).collect()) == want == [(rows[r][0], a, n, rows[q][0], b) for r, a, n, q, b in brute(rows)]
    both = sql(SQL["op2_line_dedup"], documents=df.toPandas())
    same(repeated_runs(df).toPandas(), both)


@pytest.mark.parametrize("m", [1, 3])
def test_equals_brute_force_at_any_depth(spark, m):
    r = random.Random(m)
    rows = [(i, "\n".join(r.choice(["a", "b", "b", "cc", "", " ", "\r", f"u{i}"]) for _ in range(r.randint(0, 20)))) for i in range(45)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 45, 4)] + [(200, "\n".join(["a"] * 70)), (201, "\n".join(f"v{i % 7}" for i in range(70)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, m)
    assert runs(repeated_runs(docs, min_lines=m).collect()) == sorted((rows[r][0], a, n, rows[q][0], b) for r, a, n, q, b in want)
    gone = {}
    for k, a, n, _, _ in want:
        filled = [i for i, x in enumerate(rows[k][1].split("\n")) if x.strip() and i >= a]
        gone.setdefault(k, set()).update(filled[:n])
    left = {d["doc_id"]: d["text"] for d in delete_runs(docs, min_lines=m).collect()}
    for i, (d, t) in enumerate(rows):
        assert left[d] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ()))


def test_odd_rows(spark):
    docs = odd_documents(spark, [None, "", "\n \r\n", "x\ny", "x\ny\nz", "q\nx\ny\nz\nx\ny", "Ü\n😀" * 500])
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["line_from"], r["n_lines"], r["first_doc_id"], r["first_line"]) for r in repeated_runs(docs).collect())
    # the null id comes last; row 4 repeats twice; in row 6, lines 1 and 2 repeat to its end, but for a last line that is shorter
    assert got == [(-1, 0, 2, 4, 0), (4, 0, 3, 4, 0), (4, 0, 3, 4, 0), (5, 1, 3, 4, 0), (5, 4, 2, 4, 0), (6, 2, 498, 6, 1)]
    assert repeated_runs(docs.limit(0)).count() == 0
    assert repeated_runs(spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")).count() == 0
    cut = delete_runs(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert sum(r["text"] is None for r in cut.collect()) == 2
