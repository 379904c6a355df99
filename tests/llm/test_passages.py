import hashlib

from larder.llm import passages
from tests.llm.data import documents, prose, with_clashes


def brute(rows, window=50):
    def words(t):
        import re

        return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]

    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_removal_equals_brute_force(spark):
    shared, long_shared = prose(1, 60), prose(2, 400)
    rows = [(k, f"{prose(10 + k, 30 + k)} {shared}\n{prose(40 + k, 20)} {long_shared if k % 3 == 0 else ''}") for k in range(9)]
    rows += [
        (20, shared), (21, shared), (22, " ".join(shared.split()[:49])), (23, " ".join(shared.split()[5:55])),
        (24, "x " + " ".join(shared.split()[:50]) + " y"), (25, shared.upper()), (26, None), (27, ""), (None, shared),
        (3, shared), (21, shared), (30, prose(99, 4000)), (31, prose(99, 4000) + " more"), (-4, f"{long_shared} {long_shared}"),
        (40, "same " * 120), (41, "same " * 80), (42, "the the " * 30),
    ]
    found = passages.without_repeats(with_clashes(documents(spark, rows))).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found), key=str) == brute(rows)
    for r in found:
        assert sum(b - a for a, b in zip(r["starts"], r["ends"])) == r["n_removed"]


def test_other_window(spark):
    rows = [(1, "a b c d e f g h"), (2, "x c d e f y"), (3, "c d e"), (4, "d e f z c d e")]
    found = passages.without_repeats(documents(spark, rows), window=3).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == brute(rows, 3)


def test_no_documents(spark):
    assert passages.without_repeats(documents(spark, [])).count() == 0
