"""The Merkle manifest and periodic runs against brute force, with odd rows of every kind."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import merkle, periods, queries, suffixes, warc

DATA = "/root/testdata/sf0.001"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """(root, siblings level by level of each node) by the definition."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            a = at[i] // 8 * 8
            path.append(("".join(nodes[a : at[i]]), "".join(nodes[at[i] + 1 : a + 8])))
            at[i] //= 8
        nodes = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def expected_manifest(rows):
    """By position of the row: (leaf, subroot, root, proof, folded root)."""
    leaves = [H(*(field(v) for v in row)) for row in rows]
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(row[2], []).append(i)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
    below = {g: tree([leaves[i] for i in groups[g]]) for g in order}
    root, above = tree([below[g][0] for g in order])
    out = {}
    for k, g in enumerate(order):
        for i, path in zip(groups[g], below[g][1], strict=True):
            steps, row = path + above[k], rows[i]
            node = leaves[i]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                node = H(*(field(v) for v in (*row[:4], row[4].translate(str.maketrans(UPPER, UPPER.lower())))))
            for a, b in steps:
                node = H(a, node, b)
            out[i] = (leaves[i], below[g][0], root, H(*(a + b for a, b in steps)), node)
    return out


SIZES = {None: 9, "a": 1, "b": 8, "é": 65, "d": 64, "e": 4600}


def manifest_rows():
    rng, rows, i = random.Random(5), [], 0
    for g, n in SIZES.items():
        for _ in range(n):
            text = rng.choice([None, "", "ABC", "Some Text É " * rng.randrange(4), "lower"])
            rows.append((i * 3, rng.choice([None, "src"]), g, rng.choice([None, len(text or "")]), text))
            i += 1
    rows += [rows[3], rows[3], (None, "x", "b", 1, "No Id"), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_manifest_by_the_definition(spark, partitions):
    rows = manifest_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(partitions)
    df = df.withColumns({"leaf": F.lit(1), "tree": F.lit("x"), "hash": F.lit(None).cast("string")})
    key = F.col("doc_id").cast("string").cast("binary")
    got = merkle.manifest(df, changed=F.crc32(key) % 3 == 0, change=F.translate("text", UPPER, UPPER.lower())).collect()
    want = expected_manifest(rows)
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got) == sorted((str(rows[i][0]), *w) for i, w in want.items())
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    assert 0 < sum(not r.verified for r in got) < len(got)


def test_manifest_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op12_merkle_manifest"]).df()
    got = queries.op12_merkle_manifest(spark, DATA).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(str, got[columns].values.tolist())) == sorted(map(str, want[columns].values.tolist()))


def test_manifest_of_nothing_and_of_one(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert merkle.manifest(docs.limit(0)).count() == 0
    (row,) = merkle.manifest(docs.where("doc_id = 7")).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == H()


def test_witnesses_grow_with_later_siblings():
    appender, leaves = merkle.Appender(), [H(str(i)) for i in range(100)]
    for i, leaf in enumerate(leaves):
        appender.append(leaf)
        if i == 63:  # a full tree of two levels: every witness is whole, and no later leaf alters these steps
            early = [list(w) for w in appender.witness]
            assert {merkle.fold(x, *zip(*w, strict=True)) for x, w in zip(leaves, early, strict=False)} == {tree(leaves[:64])[0]}
    root = appender.seal()
    assert root == tree(leaves)[0]
    assert all(w[:2] == e for w, e in zip(appender.witness, early, strict=False))
    assert all(merkle.fold(x, *zip(*w, strict=True)) == root for x, w in zip(leaves, appender.witness, strict=True))


# --- periodic runs ---


def expected_runs(x, least, times):
    x, n, out = np.asarray(x), len(x), []
    for q in range(1, n // times + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = b - a + q
            part = x[a : a + length]
            if length >= max(least, times * q) and not any((part[:-r] == part[r:]).all() for r in range(1, q)):
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 3), (4, 2)])
def test_runs_against_brute_force(least, times):
    rng, found = random.Random(least), 0
    for _ in range(400):
        x = [rng.randrange(rng.choice([1, 2, 2, 3, 9])) + 1 for _ in range(rng.randrange(100))]
        for _ in range(rng.randrange(3)):
            if x:
                a, p = rng.randrange(len(x)), rng.randrange(1, 9)
                for i in range(a, min(len(x), a + rng.randrange(60))):
                    x[i] = x[a + (i - a) % p]
        want = expected_runs(x, least, times)
        assert (periods.find_runs(np.array(x, np.int64), least, times) if len(x) >= least else []) == want
        found += len(want)
    assert found > 50


def test_large_ordered_sets(monkeypatch):
    monkeypatch.setattr(periods, "PART", 4)
    rng = random.Random(1)
    x = np.array([rng.randrange(2) + 1 for _ in range(300)] * 4, np.int64)
    assert periods.find_runs(x, 4, 2) == expected_runs(x, 4, 2)


def expected_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    names = {}
    runs = expected_runs([names.setdefault(x, len(names)) for x in w], 24, 3)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], H(listed), H(kept))


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_query(spark):
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in queries.op13_periodic_runs(spark, DATA).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        assert got[i] == expected_row(i, text)
    assert sum(r[1] > 0 for r in got.values()) > 10


ODD = [None, "", " \n\t", "a", "la " * 30, "la " * 23, "un deux trois " * 9 + "fin", "ünï " * 40 + "x　y " * 20, "z\x1c " * 24, "ab cd " * 50_000]


def test_runs_of_odd_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "la " * 40, 2), (4, "la " * 30, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    out = periods.measure_runs(df).select("doc_id", "text", "runs.*").collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_runs, r.period, r.collapsed_sha256) == tuple(expected_row(None, r.text if len(r.text or "") < 10_000 else "ab cd " * 200)[i] for i in (1, 4, 7))
    listed = {r.doc_id: r.runs for r in periods.list_runs(df.where("doc_id is not null")).collect()}
    assert [tuple(x) for x in listed[6]] == [(0, 27, 3)] and listed[0] == [] and [tuple(x) for x in listed[9]] == [(0, 100_000, 2)]
    kept = {r.doc_id: r.text for r in periods.collapse_runs(df.where("doc_id is not null")).collect()}
    assert kept[0] is None and kept[4] == "la" and kept[6] == "un deux trois fin" and kept[5] == ("la " * 23).strip()
    assert periods.measure_runs(df.limit(0)).count() == 0


def test_looped_texts(spark):
    rows = [(i, " ".join(f"w{i % 7}x{j}" for j in range(i % 40))) for i in range(300)] + [(None, "a b c"), (3, None)]
    df = spark.createDataFrame(rows, "k long, text string")
    for r in df.select("k", "text", periods.looped(F.col("text"), F.col("k")).alias("out")).collect():
        w = (r.text or "").split()
        if r.k is None or not w:
            assert r.out == r.text
            continue
        g = zlib.crc32(str(r.k).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        assert r.out.split() == [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


# --- repeated passages ---


def expected_cut(rows, n):
    """By row: (removed, runs, rest) of (id, text) pairs."""
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - n + 1) if i is not None else ():
            w = raw[k : k + n]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - n + 1) if i is not None else ():
            if first[raw[k : k + n]] < i:
                gone[k : k + n] = b"\x01" * n
        runs = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


def passages(seed, count=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    shared = [" ".join(word() for _ in range(k)) for k in (5, 12, 20, 40)]
    rows = [(i * 7 % 101, " ".join(rng.choice(shared) if rng.random() < 0.3 else word() for _ in range(rng.randrange(60)))) for i in range(count)]
    rows += [(500, None), (501, ""), (502, "x" * 300), (503, "y" + "x" * 120 + "z"), (504, shared[3]), (505, shared[3]), (505, shared[3] + " tail"), (505, shared[3]), (None, shared[3]), (None, None), (506, "short")]
    rows += [(700 + i, f"{word()} {shared[2]} {word()}") for i in range(30)]
    return rows


@pytest.mark.parametrize(("n", "hot"), [(50, 10_000), (50, 3), (8, 5), (2, 10_000)])
def test_repeats_by_the_definition(spark, n, hot):
    rows = passages(n + hot)
    df = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id long, text string, cut double").repartition(5)
    got = suffixes.cut_repeats(df, n=n, hot=hot).select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept").collect()
    key = lambda r: (r[0] is not None, r[0] or 0, bytes(r[4]), *r[1:4])
    assert sorted([(*r[:4], bytes(r[4])) for r in got], key=key) == sorted(expected_cut(rows, n), key=key)
    assert suffixes.cut_repeats(df.limit(0), n=n).count() == 0


def test_repeats_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_suffix_repeats(spark, DATA).collect()}
    assert got == {i: (a, b, c, hashlib.sha256(rest).hexdigest()) for i, a, b, c, rest in expected_cut(rows, 50)}
    assert sum(v[1] > 0 for v in got.values()) > 10


@pytest.mark.parametrize("seed", range(4))
def test_transform_orders_all_suffixes(seed):
    rng = random.Random(seed)
    for _ in range(60):
        strings = [bytes(rng.choice(b"abc\x00\xff"[: rng.randrange(1, 6)]) for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 9))]
        of, size, common = (x.tolist() for x in suffixes.transform(strings))
        suffix = [strings[o][len(strings[o]) - z :] for o, z in zip(of, size, strict=True)]
        assert suffix == sorted(suffix) and len(suffix) == sum(map(len, strings)) + len(strings)
        for a, b, k in zip(suffix, suffix[1:], common[1:], strict=False):
            assert a[:k] == b[:k] and (len(a) == k or len(b) == k or a[k] != b[k])


def test_strings_cover_every_window_once():
    rng = random.Random(9)
    for n in (2, 5, 50):
        texts = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 1, n - 1, n, n + 1, 300]))).encode() for _ in range(9)]
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        anchor, text, begin, windows = suffixes.anchored(np.frombuffer(b"".join(texts), np.uint8), at, n)
        seen, key, whole = [], {}, b"".join(texts)
        for a, t, b, w in zip(anchor.tolist(), text.tolist(), begin.tolist(), windows.tolist(), strict=True):
            assert 0 < w <= suffixes.MOST
            for j in range(b, b + w):
                assert at[t] <= j and j + n <= at[t + 1]
                assert key.setdefault(whole[j : j + n], a) == a
                seen.append(j)
        assert sorted(seen) == [j for t in range(9) for j in range(at[t], at[t + 1] - n + 1)]


def test_revisits_refer_to_a_record_of_the_archives(spark, tmp_path):
    """A reader of its own: gzip members, headers split at line ends, nothing of the library."""
    import gzip

    rows = [(i, f"https://a.org/{i}", "p" * 200 if i % 2 else f"page {i} " * 30) for i in range(20)] + [(1, "https://a.org/1", "p" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(warc.judge(pages), str(tmp_path / "w"))
    ids, refers = [], []
    for path in (tmp_path / "w").rglob("*.gz"):
        for line in gzip.decompress(path.read_bytes()).decode().split("\r\n"):
            name, _, value = line.partition(": ")
            if name == "WARC-Record-ID":
                ids.append(value)
            if name == "WARC-Refers-To":
                refers.append(value)
    assert len(refers) == 9 and set(refers) <= set(ids)
    got = warc.captures(warc.round_trip(pages)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id % 2) == sorted((i, "response" if i == 1 else "revisit", None if i == 1 else 1) for i, _, _ in rows if i % 2)


def test_half_of_the_urls_null_spread_over_tasks(spark):
    from tessella.llm import urls

    rows = spark.range(4000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("https://x.org/"), F.col("id").cast("string"))).alias("url"))
    out = urls.filter_urls(rows.repartition(8), queries.URL_RULES)
    sizes = [r["count"] for r in out.where("url is null" if "url" in out.columns else "host = ''").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 1000
    assert {r.verdict for r in out.where("host = ''").select("verdict").distinct().collect()} <= {"allow", "block"}
