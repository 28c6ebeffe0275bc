"""Near copies by shingle overlap against brute force, on planted copies."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

pytest.importorskip("xxhash")
from tessella.llm import nearcopies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """The smallest id of each row's class."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(sets), 2):
        a, b = sets[i], sets[j]
        if (not a and not b) or 5 * len(a & b) >= 4 * len(a | b):
            p, q = find(i), find(j)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


@pytest.fixture(scope="module")
def planted():
    """Copies with 0 to 8 changed words around the limit, short texts, a common passage and a crowd of near copies."""
    r = random.Random(7)
    word = lambda: f"w{r.randrange(5000)}"
    passage, texts = [word() for _ in range(30)], ["", None, " ", "one two", "one two", "a b c d e", "a b c d f"]
    for _ in range(25):
        base = [word() for _ in range(r.randrange(20, 160))] + passage
        texts.append(" ".join(base))
        for k in range(8):
            changed = list(base)
            for _ in range(k):
                changed[r.randrange(len(base))] = word()
            texts.append(" ".join(changed))
    base = [word() for _ in range(120)]
    for k in range(150):
        changed = list(base)
        for _ in range(k % 5):
            changed[r.randrange(120)] = word()
        texts.append(" ".join(changed))
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize(("crowd", "block"), [(64, 512), (3, 8), (10_000, 512)])
def test_classes_against_brute_force(spark, planted, crowd, block):
    got = nearcopies.near_copies(spark.createDataFrame(planted, "doc_id long, text string").repartition(5), crowd=crowd, block=block)
    assert {r.id: r.component_id for r in got.collect()} == brute(planted)


def test_stage_keeps_one_of_each_class(spark, planted):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in planted], SCHEMA)
    kept = dict(corpus_pipeline.STAGES)["simhash_dedup"](spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(planted).values()))


def test_rows_without_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, base), (None, base + " x"), (None, base), (4, "p q r s t u v"), (None, "p q r s t u v")]
    kept = nearcopies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {None, 4}
    assert nearcopies.keep_one(spark.createDataFrame([], "doc_id long, text string")).agg(F.count("*")).first()[0] == 0


def test_fingerprints_find_their_pairs(spark, planted):
    """Step 1 is SimHash: its pairs join exactly the sets that fingerprints at four or fewer differing bits join."""
    sets = {i: nearcopies.shingles(t) for i, t in planted if (t or "").split()}
    prints = {nearcopies._key(x): nearcopies.fingerprint(x) for x in sets.values()}
    for x in sets.values():
        ones = [sum(int(h) >> b & 1 for h in x) for b in range(64)]
        assert nearcopies.fingerprint(x) % 2**64 == sum(1 << b for b in range(64) if 2 * ones[b] > len(x))
    pairs = nearcopies.fingerprint_pairs(spark.createDataFrame(list(prints.items()), "key long, fp long")).collect()
    near = {frozenset((a, b)) for a, b in combinations(prints, 2) if ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 4}
    assert near and {frozenset((r.a, r.b)) for r in pairs} <= near

    def joined(links):
        root = {k: k for k in prints}

        def find(k):
            while root[k] != k:
                k = root[k]
            return k

        for a, b in map(tuple, links):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
        return {k: find(k) for k in prints}

    assert joined((r.a, r.b) for r in pairs) == joined(near)


def test_shared_passage_makes_no_candidate(spark):
    """Prefixes that share less than the limit needs are no candidates, those that share enough are; crowded shingles may be shared."""
    rows = [(t, 1, 100, t) for t in range(21)] + [(t if t < 9 else 100 + t, 2, 100, t) for t in range(21)] + [(t if t < 10 else 200 + t, 3, 100, t) for t in range(21)]
    few = spark.createDataFrame(rows, "tok long, key long, n int, pos int")
    # 89 of 100 must be shared and 79 are behind the prefix, so ten of it have to be; sets 2 and 3 share nine.
    assert [tuple(r) for r in nearcopies.prefix_pairs(few).collect()] == [(1, 3)]
    crowded = spark.createDataFrame([(900, 1, 100, 20), (900, 2, 100, 20), (901, 3, 100, 20)], "tok long, key long, n int, pos int")
    assert sorted(tuple(r) for r in nearcopies.prefix_pairs(few, crowded).collect()) == [(1, 2), (1, 3), (2, 3)]
