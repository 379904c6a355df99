import hashlib

from larder.llm import lines
from tests.llm.data import documents, prose, with_clashes

SHARED = "a line that is long enough to count as one that is shared"
ROWS = [
    *((k, f"own {k}\n  {SHARED.upper()}\t\n{SHARED}\nend") for k in range(7)),
    (7, SHARED[:39]), (8, None), (9, ""), (10, "\n"), (11, prose(1, 30_000)), (3, f"again\n{SHARED}"),
    (None, f"{SHARED}\nx"), (5, f"own 5\n  {SHARED.upper()}\t\n{SHARED}\nend"),
    *((20 + k, "four documents hold this line, which is one too few") for k in range(4)),
]


def brute(rows):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40 and i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        shared = [holders.get(key(x), ()) for x in own]
        kept = [x for x, h in zip(own, shared) if len(h) < 5 or i == max(h)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def test_digests_and_bitmaps_equal_brute_force(spark):
    found = lines.line_digests(with_clashes(documents(spark, ROWS))).collect()
    expected = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(ROWS)]
    assert sorted((tuple(r)[:4] for r in found), key=str) == sorted(expected, key=str)
    for r in found:
        assert sum(r["keep_runs"]) == r["n_lines"] and sum(r["keep_runs"][1::2]) == r["n_dropped"]


def test_texts_without_shared_lines(spark):
    df = with_clashes(documents(spark, ROWS))
    kept = lines.without_shared_lines(df)
    assert kept.columns == df.columns
    found = sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=str)
    assert found == sorted(((i, t) for i, _, _, t in brute(ROWS)), key=str)


def test_no_python_in_the_plan(spark):
    plan = lines.line_digests(documents(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_documents(spark):
    assert lines.line_digests(documents(spark, [])).count() == 0


def test_a_line_streams_in_order_over_many_stretches(spark):
    rows = [(k, f"{SHARED}\nown {k}\n{SHARED}") for k in range(3000)] + [(None, SHARED)]
    found = {r["doc_id"]: r for r in lines.keep_bitmaps(documents(spark, rows)).collect()}
    assert found.keys() == {None, *range(2999)}
    assert all(found[k]["keep_runs"] == [0, 1, 1, 1, 0] for k in range(2999))
    assert found[None]["keep_runs"] == [0, 1, 0]


def test_occurrences_are_sorted_in_ranges_and_moved_once(spark):
    seen = spark.createDataFrame(
        [(bytes([k % 3]), k // 10, k, 0, 1, b"t") for k in range(60)],
        "key binary, stretch int, doc_id long, pos int, n_lines int, text_key binary",
    )
    df = lines.in_order(seen)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1
    assert "doc_id#" in plan.split("Sort [key#")[1].split("\n")[0] and "pos#" in plan.split("Sort [key#")[1].split("\n")[0]
    assert plan.count("Window") >= 1
    first = {(r["key"], r["stretch"]): r["doc_id"] for r in df.where("place = 1").collect()}
    assert all(d == max(k for k in range(60) if bytes([k % 3]) == key and k // 10 == s) for (key, s), d in first.items())
