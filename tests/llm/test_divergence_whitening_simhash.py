"""Source divergence, whitening and SimHash against plain versions, and on odd rows."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sondaflow.llm import divergence, queries, simhash, whitening

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"
LONG = " ".join(f"word{k % 977}x{k}" for k in range(60_000))
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", None), (4, "one", "de", "a"), (4, "one", "de", "a"),
       (None, "one", None, "b"), (5, LONG, "en", "b"), (6, LONG + " end", "en", "b"), (7, "x" * 300_000, "en", "c"),
       (8, "É ü 漢字 😀 É Straße" * 3, "fr", "c"), (9, "12 34 !!", "es", "c"), (10, "a b c d e f", "en", "\U0001F600"),
       (11, "A B c d e f", "en", "￿"), (12, "a b c d e f", "en", "a")]


def frame(spark, rows, schema=DOCS, clashes=("term", "n", "p", "id", "print", "mask", "key", "x", "value", "rank", "item")):
    out = spark.createDataFrame(rows, schema)
    for name in clashes:
        out = out.withColumn(name, F.lit("x"))
    return out


# ---- source divergence

def plain_audit(rows, least=10, first=10):
    lower = {c: c + 32 for c in range(65, 91)}
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower)))
            for _, text, lang, source in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    sources = defaultdict(set)
    for lang, source, said in docs:
        seen[lang].update(set(said))
        count[lang, source].update(said)
        sources[lang].add(source)
    out = set()
    for lang, names in sources.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        whole = sum((count[lang, s] for s in names), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(count[lang, s]) for s in names}
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in names:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in names if o != s]
            own = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", own)):
                found.sort(key=lambda r: (-r[0], r[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)
                        if part == "pair" or k < first}
    return out


def found(rows):
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("least", [1, 2, 10])
def test_divergence_of_odd_rows(spark, least):
    assert found(divergence.audited(frame(spark, ODD), least_documents=least)) == plain_audit(ODD, least)


def test_divergence_of_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    got = found(queries.op11_source_divergence(spark, FOLDER))
    assert got == plain_audit(rows) and {r[2] for r in got} == {"pair", "term"}


def test_divergence_with_one_hot_source_in_small_blocks_and_tasks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(f"t{''.join(chr(97 + int(d)) for d in str(w))}" for w in rng.zipf(1.4, 30) % 400), "en",
             "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(600)]
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 64)
    assert found(divergence.audited(frame(spark, rows).repartition(5))) == plain_audit(rows)


def test_divergence_of_nothing_and_of_texts_without_words(spark):
    assert divergence.audited(frame(spark, [])).count() == 0
    bare = [(1, None, "en", "a"), (2, "12", "en", "b"), (3, "", "de", "c")]
    assert found(divergence.audited(frame(spark, bare))) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_shares_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**11, 3 * 10**11, 7)], "n long, total long, terms long")
    assert row.select(divergence._share("n", "total", "terms")).first()[0] == \
        1 + 10**9 * (10**11 + 2) // (3 * 10**11 + 14)


# ---- whitening

VECTORS = "vec_id long, embedding array<float>"


def plain_moments(vectors):
    """Number, sums and exact covariance of the distinct whole vectors."""
    fit = sorted(set(vectors))
    n, dim = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(dim)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(dim)] for i in range(dim)]
    return n, sums, np.array(cov)


def whole(vector):
    if vector is None or not len(vector) or any(c is None or not np.isfinite(c) for c in vector):
        return None
    return tuple(int(np.floor(256 * float(np.float32(c)))) for c in vector)


def check_whitening(rows, got, components=4):
    kept = [(id, whole(v)) for id, v in rows if whole(v) is not None]
    n, sums, cov = plain_moments([x for _, x in kept])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, len(sums))
    assert len(got) == len(kept) * count
    by = defaultdict(list)
    for r in got:
        by[r.vec_id, r.component].append(r)
    signs = {}
    for id, x in kept:
        for c in range(1, count + 1):
            r = by[id, c]
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            assert deviation in {q.deviation for q in r} and {q.n for q in r} == {n}
            expected = float((np.array(x) - np.array(sums) / n) @ vectors[:, c - 1] / np.sqrt(values[c - 1]))
            same = [q.whitened for q in r if q.deviation == deviation]
            if abs(expected) > 1e-6 and c not in signs:
                signs[c] = np.sign(expected * same[0])
            assert min(abs(w - signs.get(c, 1) * expected) for w in same) < 1e-8 * max(1, abs(expected))
            assert abs(r[0].explained - values[c - 1] / values.sum()) < 1e-9 and r[0].identity_error < 1e-10


def test_whitening_of_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check_whitening(rows, queries.op12_whitening(spark, FOLDER).collect())


def test_whitening_with_odd_rows_and_a_hot_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=6).astype(np.float32).tolist()) for k in range(40)]
    rows += [(100 + k, rows[0][1]) for k in range(30)] + [(3, rows[3][1]), (3, rows[4][1])]
    odd = [(200, None), (201, [1.0, None] * 3), (202, [float("nan")] * 6), (203, [float("-inf")] * 6), (204, [])]
    given = frame(spark, rows + odd, VECTORS, ("x", "dim", "i", "component", "n", "w", "whitened"))
    check_whitening(rows, whitening.whitened(given.repartition(4)).collect())
    assert whitening.whitened(frame(spark, odd, VECTORS, ())).count() == 0
    assert whitening.whitened(frame(spark, [], VECTORS, ())).count() == 0
    assert {r.vec_id for r in whitening.whitened(frame(spark, [(None, [1.0, 2.0]), (1, [2.0, 5.0])], VECTORS, ())).collect()} \
        == {None, 1}


def test_components_without_variance(spark):
    one = whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])], VECTORS, ())).collect()
    assert len(one) == 4
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}
    line = whitening.whitened(frame(spark, [(k, [float(k), float(k), 0.0]) for k in range(5)], VECTORS, ())).collect()
    assert all((r.whitened is None) == (r.component > 1) and abs(r.explained - (r.component == 1)) < 1e-12 for r in line)
    assert max(r.identity_error for r in line) < 1e-12


def test_vectors_of_two_lengths_and_of_a_great_length(spark):
    rng = np.random.default_rng(4)
    short = [(k, rng.normal(size=3).tolist()) for k in range(20)]
    long = [(100 + k, rng.normal(size=300).tolist()) for k in range(350)]
    got = whitening.whitened(frame(spark, short + long, VECTORS, ())).collect()
    check_whitening(short, [r for r in got if r.vec_id < 100])
    assert len(got) == 60 + 1400 and max(r.identity_error for r in got) < 1e-10


def test_sums_beyond_doubles(spark):
    rows = [(k, [1e6 + k, 3e6 - k * k, 2e6 + float(k % 3)]) for k in range(60)]
    got = whitening.moments(frame(spark, rows, VECTORS, ()).select(
        whitening.integers(F.col("embedding")).alias("x")).distinct())[3]
    n, sums, cov = plain_moments([whole(v) for _, v in rows])
    assert (got.n, got.sums) == (n, sums) and np.allclose(got.covariance.astype(float), cov, rtol=1e-15, atol=0)


SPECTRA = {"spread": list(range(1, 65)), "equal": [5.0] * 8, "two levels": [7, 7, 7, 3, 3, 0, 0, 0],
           "scales": [1, 1e-8, 1e-16], "near": [100, 50, 50 + 1e-9, 50 - 1e-9, 20, 1e-3] + [1 + 1e-12 * k for k in range(10)]}


@pytest.mark.parametrize("name", SPECTRA)
def test_refined_eigenvectors(name):
    high, values = whitening.HIGH, np.array(sorted(SPECTRA[name], reverse=True), whitening.HIGH)
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(len(values),) * 2))[0].astype(high)
    for _ in range(6):
        q = q @ (1.5 * np.eye(len(q), dtype=high) - 0.5 * (q.T @ q))
    a = (q * values) @ q.T
    got, x = whitening.eigenvectors((a + a.T) / 2)
    assert np.abs(got - values).max() < 1e-15 * values[0]
    assert np.abs(a @ x - x * got).max() < 1e-15 * values[0] and np.abs(x.T @ x - np.eye(len(x))).max() < 1e-15
    gaps = np.abs(values[:, None] - values) + np.diag(np.full(len(values), np.inf))
    for k in np.flatnonzero(gaps.min(axis=1) > 1e-9 * values[0]):  # the others have no direction to compare
        assert abs(abs((q[:, k] * x[:, k]).sum()) - 1) < 1e-12


# ---- SimHash

def plain_print(text, words=3):
    said = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    width = min(words, len(said))
    runs = [" ".join(said[i:i + width]) for i in range(len(said) - width + 1)] if said else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """By row: the smallest id that is reached over prints within two bits; ids may be null."""
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for k, (id, _) in enumerate(prints):
        if id is not None:
            least[find(k)] = min(id, least.get(find(k), id))
    return [least.get(find(k)) for k in range(len(prints))]


def check_simhash(rows, got):
    prints = [(id, plain_print(text)) for id, text in rows]
    expected = Counter((id, f"{p:016x}", c) for (id, p), c in zip(prints, plain_components(prints)))
    assert Counter(map(tuple, got)) == expected


def test_simhash_of_odd_rows(spark):
    check_simhash([r[:2] for r in ODD], simhash.near_duplicates(frame(spark, ODD)).collect())
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_simhash_of_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    check_simhash(rows, queries.op13_simhash(spark, FOLDER).collect())


def test_fingerprints_hash_like_the_engine(spark):
    text = "Eins zwei É"
    row = spark.createDataFrame([(1, text)], "doc_id long, text string")
    same = row.select(F.xxhash64(F.lit("eins zwei É"))).first()[0]
    assert simhash.fingerprints(row).first().print == same


def test_long_texts_are_hashed_in_parts(monkeypatch):
    whole_text = simhash.fingerprint(LONG.encode(), 3)
    monkeypatch.setattr(simhash, "HELD_HASHES", 1000)
    assert simhash.fingerprint(LONG.encode(), 3) == whole_text


def near_prints(rng, n, bases=6, flips=3):
    """Numbers around a few bases, so that there are chains, and some that differ in three bits and stay apart."""
    base = rng.integers(0, 1 << 63, bases).astype(np.uint64)
    out = base[rng.integers(0, bases, n)]
    for _ in range(flips):
        out ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return out


def test_bit_sliced_forest_equals_all_pairs():
    rng = np.random.default_rng(6)
    for n in (1, 2, 63, 64, 65, 200, 500):
        prints = near_prints(rng, n, flips=int(rng.integers(1, 5)))
        cuts = np.unique(np.concatenate(([0, n], rng.integers(0, n, 3))))
        got = simhash.forest(prints, cuts)
        for a, b in zip(cuts[:-1], cuts[1:]):
            expected = plain_components([(k, int(p)) for k, p in zip(range(a, b), prints[a:b])])
            assert got[a:b].tolist() == expected


@pytest.mark.parametrize("bucket", [4096, 64])
def test_links_over_buckets_that_are_divided_again(spark, bucket, monkeypatch):
    """A third of all fingerprints share most of their bits, so buckets are divided down to the last bits."""
    monkeypatch.setattr(simhash, "PLACES", 100)
    rng = np.random.default_rng(7)
    hot = np.uint64(0x1234_5678_9ABC_D000) + rng.integers(0, 1 << 11, 150).astype(np.uint64)
    prints = sorted({int(p) for p in np.concatenate((hot, near_prints(rng, 300)))})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "print long").repartition(3), bucket).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in found:
        u, v = u % (1 << 64), v % (1 << 64)
        root[max(find(u), find(v))] = min(find(u), find(v))
    expected = plain_components([(p, p) for p in prints])
    assert [find(p) for p in prints] == expected
