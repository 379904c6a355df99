from collections import Counter

import numpy as np

from larder.llm import decontaminate
from tests.llm.data import documents, prose, with_clashes

ITEMS = [(k, prose(500 + k, 15 + 3 * k)) for k in range(12)] + [(50, "just three words"), (51, None), (52, "")]


def brute(rows, items, least=0.8):
    def words(t):
        return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]

    out = {}
    for d, t in rows:
        w = words(t)
        for i, item in items:
            own = words(item)
            size = min(5, len(own))
            if not own:
                continue
            grams = Counter(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
            for a in range(len(w) - len(own) + 1):
                here = Counter(tuple(w[k : k + size]) for k in range(a, a + len(own) - size + 1))
                shared = (here & grams).total()
                value = shared / (here | grams).total()
                if value >= least and value > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (value, a)
    return out


def test_found_equals_brute_force(spark):
    draw = np.random.default_rng(1)
    rows = []
    for k, (_, item) in enumerate(ITEMS[:12]):
        words = item.split()
        changed = list(words)
        changed[len(words) // 2] = "other"
        for j, part in enumerate((words, changed, words[: len(words) // 2], [w.upper() for w in words])):
            rows.append((k * 10 + j, f"{prose(k * 7 + j, int(draw.integers(0, 60)))}\n{' '.join(part)} {prose(k + 900, 25)}"))
    rows += [(200, "has Just\tthree words in it"), (201, None), (202, ""), (203, prose(77, 3000)), (None, ITEMS[3][1]), (204, f"{ITEMS[2][1]} {ITEMS[2][1]} {ITEMS[5][1]}")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block in (1_000_000, 40):
        found = decontaminate.contaminated(with_clashes(documents(spark, rows)), bench, words_per_block=block).collect()
        got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"]) for r in found}
        assert got == brute(rows, ITEMS)
    clean = decontaminate.without_contaminated(with_clashes(documents(spark, rows)), bench)
    gone = {d for d, _ in got}
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, _ in rows if d not in gone)


def test_documents_shorter_than_an_item(spark):
    def grams(words):
        return Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))

    items = [(k, prose(700 + k, 50 + k)) for k in range(6)] + [(20, "just three words")]
    cut = [(k * 10 + j, part) for k, (_, item) in enumerate(items[:6]) for j, part in enumerate((
        item.split()[:-2], item.split()[5:], item.split()[3:-4], item.split()[:-11], item.split()[:20], item.split()[:4],
    ))]
    rows = [(d, " ".join(w)) for d, w in cut] + [(200, "just three"), (201, "words")]
    expected = {}
    for d, words in cut:
        for i, item in items[:6]:
            one, other = grams(words), grams(item.split())
            value = (one & other).total() / (one | other).total()
            if value >= 0.8:
                expected[d, i] = (value, 0, len(words))
    assert len(expected) >= 12
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(documents(spark, rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"], r["n_words"]) for r in found} == expected
    clean = {r["doc_id"] for r in decontaminate.without_contaminated(documents(spark, rows), bench).collect()}
    assert clean == {d for d, _ in rows} - {d for d, _ in expected}


def test_index_finds_all_within_the_radius():
    draw = np.random.default_rng(5)
    items = decontaminate.Items([(k, decontaminate.words_of(prose(k, 40))) for k in range(60)])
    prints = items.prints[draw.integers(0, 60, 200)].copy()
    for k in range(200):
        for b in draw.choice(64, k % 30, replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(b)
    apart = np.bitwise_count(prints[:, None] ^ items.prints[None, :])
    assert set(zip(*(x.tolist() for x in items.near(prints)))) == set(zip(*(x.tolist() for x in np.nonzero(apart <= items.radius))))


def test_nothing_to_find(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(documents(spark, [(1, "a b c")]), bench).count() == 0
    assert decontaminate.without_contaminated(documents(spark, [(1, "a b c")]), bench).count() == 1
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contaminated(documents(spark, []), some).count() == 0
