"""How far the sources of a language differ in their words.

Terms come from a translate table: one pass over a text's bytes lowers A-Z and blanks
all other ASCII bytes that are no letters, a split gives the terms, a ``Counter`` per
document their counts and the document's share in their frequencies. Tasks add up the
counters of their documents by language and source before anything is shuffled; from
then on the counts are sparse rows (lang, source, term).

A term's share in a group is ``1 + floor(SCALE * (count + 2) / (N + 2 * V))``, so absent
terms have one too. Sources are compared over all kept terms of their language: blocks
of terms are dealt to tasks, each with all sources of the language, and every block
gives one partial sum per pair of sources. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sondaflow.llm.tables import written

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 10
FIRST_TERMS = 10
# Distinct (group, term) entries that a task adds up before it passes them on.
HELD_TERMS = 200_000
# Terms of a block, and entries of its matrix of sources by terms.
BLOCK_TERMS = 2048
BLOCK_ENTRIES = 1 << 22

# A-Z become a-z, a-z and the bytes of other characters stay, all else is blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(TERM_BYTES).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple, Counter] = defaultdict(Counter)
    documents: dict[tuple, Counter] = defaultdict(Counter)
    seen: set[tuple] = set()

    def passed_on() -> pa.RecordBatch:
        columns: tuple[list, ...] = ([], [], [], [], [])
        for (lang, source), group in counts.items():
            n = len(group)
            columns[0].extend([lang] * n)
            columns[1].extend([source] * n)
            columns[2].extend(group)
            columns[3].extend(group.values())
            columns[4].extend(map(documents[lang, source].__getitem__, group))
        for lang, source in seen:  # a group is known by a row without a term
            for column, value in zip(columns, (lang, source, None, 0, 0)):
                column.append(value)
        counts.clear()
        documents.clear()
        seen.clear()
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          ["lang", "source", "term", "n", "docs"])

    held = 0
    for batch in batches:
        for text, lang, source in zip(*(batch.column(c) for c in ("text", "lang", "source"))):
            group = lang.as_py(), source.as_py()
            seen.add(group)
            found = Counter(terms(text.as_py()))
            mine = counts[group]
            held -= len(mine)
            mine.update(found)
            held += len(mine)
            documents[group].update(found.keys())
            if held >= HELD_TERMS:
                yield passed_on()
                held = 0
    yield passed_on()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences of a term in a group and documents that hold it.
    Each group also has a row without a term."""
    given = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(as_) for c, as_ in ((lang, "lang"), (source, "source")))
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), *given)
    return (rows.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
            .groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(count: str, total: str, kept: str) -> Column:
    return F.expr(f"1 + cast({SCALE} as decimal(10,0)) * ({count} + 2) div ({total} + 2 * {kept})")


def _distance(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def _block_sums(key: tuple, rows: pa.Table) -> pa.Table:
    """Partial sums over the terms of a block, per pair of sources. Rows without a term give each
    source and its share of a term it lacks."""
    term, source = rows.column("term"), rows.column("source")
    share = np.asarray(rows.column("p"))
    group = np.asarray(pc.is_null(term))
    sources = source.filter(pa.array(group)).combine_chunks()
    order = np.asarray(pc.sort_indices(sources))
    sources, absent = sources.take(pa.array(order)), share[group][order]
    held = pa.array(~group)
    names = term.filter(held).combine_chunks().dictionary_encode()
    columns = np.asarray(names.indices)
    lines = np.asarray(pc.index_in(source.filter(held).combine_chunks(), sources))
    matrix = np.repeat(absent[:, None], len(names.dictionary), axis=1)
    matrix[lines, columns] = share[~group]
    left, right, sums = [], [], []
    for k in range(len(matrix) - 1):
        mine, others = matrix[k], matrix[k + 1:]
        apart = others - mine
        sums.append((apart * apart // (others + mine)).sum(axis=1))
        left.append(np.full(len(others), k))
        right.append(np.arange(k + 1, len(matrix)))
    if not sums:
        return pa.table({"lang": [], "source": [], "item": [], "value": []}, _SUMS)
    left, right, sums = map(np.concatenate, (left, right, sums))
    return pa.table({"lang": pa.array([key[0].as_py()] * len(sums), pa.string()), "source": sources.take(pa.array(left)),
                     "item": sources.take(pa.array(right)), "value": pa.array(sums)}, _SUMS)


_SUMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _ranked(rows: DataFrame, part: str, first: int | None = None) -> DataFrame:
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rows = rows.withColumn("rank", F.row_number().over(place).cast("int"))
    if first is not None:
        rows = rows.filter(F.col("rank") <= first)
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audited(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
            least_documents: int = LEAST_DOCUMENTS, first_terms: int = FIRST_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part ``pair`` compares each source with every other of its language over the terms
    that at least ``least_documents`` documents of the language hold: zero if it keeps no
    term. Part ``term`` gives the ``first_terms`` terms of which a source has a larger share
    than its language, with their distance. Ranks go by value, largest first, ties by item
    in the order of its bytes.

    Null texts, languages and sources count as empty ones; a source without any term is
    compared like others, and a language with one source has no pair. Repeated rows count
    as documents of their own. A long text is one counter at a time; a long word is one
    term. No rows give no rows; other columns play no part. Counts may be so large that
    the shares' numerators need more than 64 bits.
    """
    counts = written(term_counts(docs, text, lang, source), "counts")
    found = counts.filter("term is not null")
    kept = written(found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                   .filter(F.col("docs") >= least_documents).select("lang", "term", "lang_n"), "kept")
    present = written(found.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "present")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = (counts.filter("term is null").groupBy("lang").agg(F.count(F.lit(1)).alias("sources")))
    groups = written(
        counts.filter("term is null").select("lang", "source").join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left").join(per_lang, "lang")
        .select("lang", "source", F.coalesce("terms", F.lit(0)).cast("long").alias("terms"), "lang_total",
                F.coalesce("total", F.lit(0)).alias("total"),
                # As many blocks as the language's terms need, so that a matrix stays small.
                F.expr(f"cast(ceil(coalesce(terms, 0) / greatest(64, least({BLOCK_TERMS}, {BLOCK_ENTRIES} div sources)))"
                       " as long)").alias("blocks")), "groups")

    shares = present.join(groups, ["lang", "source"]).withColumns({
        "p": _share("n", "total", "terms"), "q": _share("lang_n", "lang_total", "terms")})
    own = shares.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), _distance("p", "q").alias("value"))

    dealt = shares.select("lang", F.expr("pmod(xxhash64(term), blocks)").alias("block"), "source", "term", "p")
    absent = groups.filter("blocks > 0").select(
        "lang", F.explode(F.expr("sequence(0l, blocks - 1)")).alias("block"), "source",
        F.lit(None).cast("string").alias("term"),
        F.expr(f"1 + 2 * {SCALE}l div (total + 2 * terms)").alias("p"))
    sums = written(
        dealt.unionByName(absent).groupBy("lang", "block")
        .applyInArrow(_block_sums, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "sums")
    # A language without a kept term has its pairs, too.
    empty = groups.filter("blocks = 0").select("lang", "source")
    bare = (empty.join(empty.withColumnRenamed("source", "item"), "lang").filter("source != item")
            .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    pairs = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    return _ranked(pairs.unionByName(bare), "pair").unionByName(_ranked(own, "term", first_terms))
