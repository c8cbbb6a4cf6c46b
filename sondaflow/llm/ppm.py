"""Texts scored by prediction by partial matching, beside a word unigram score.

The training texts give one count per (order + 1)-gram of bytes, summed over all
of them; lower orders follow from it. Every counted string is kept: the trie is a
written table per order, joined order by order, so it grows with the input and is
never in one place. The strings of held-out texts stand in it with a count of 0.

A symbol is coded in its longest known context. Where it is new there, an escape is
coded (method C: distinct symbols against all counts) and the next shorter context
follows, without the symbols that the longer one has ruled out; below order 0 the
symbols left are equally likely. The code length is the sum over the text's bytes
and its end. Every string's suffix is kept with it, so the symbols of a context are
also symbols of its suffix, and sums over ruled-out symbols are made beforehand.

A symbol's probability depends on its string of order + 1 bytes alone, so the trie
gives one number per distinct string. Those numbers and the word counts meet all
texts by a join: documents form bundles of a few megabytes, each asks for its
distinct strings and words once, and the answers come back to the bundle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.llm.bytegrams import Counter, find, grams, lookup
from sondaflow.llm.tables import row_blocks, text_bytes, written
from sondaflow.llm.words import lowered, word_hashes

ORDER = 4
BUNDLE_BYTES = 8 << 20
SYMBOLS = 255     # all bytes but the one before a text
END_WORD = np.array([0x454E44], np.uint64)  # the end token among word hashes
GRAM, WORD = 0, 1


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, words, ends = Counter(), Counter(), 0

        def rows(counter: Counter, kind: int) -> Iterator[pa.RecordBatch]:
            for keys, counts in counter.columns():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), kind, np.int32)), keys, counts], ["kind", "key", "n"])

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in row_blocks(offsets):
                part = lowered(data[offsets[first]:offsets[last]]), offsets[first:last + 1] - offsets[first]
                strings.add(grams(*part, order)[0])
                words.add(word_hashes(*part)[0])
                ends += last - first
                if strings.full:
                    yield from rows(strings, GRAM)
                if words.full:
                    yield from rows(words, WORD)
        words.add(np.repeat(END_WORD, ends))
        yield from rows(strings, GRAM)
        yield from rows(words, WORD)
    return run


# ---- the trie

def _mask(size: int) -> int:
    return (1 << (8 * size)) - 1


def _log10(order: int):
    """Adds log10 of the probability of each string's symbol to rows of its counts and contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ruled_out, ruled_symbols = (np.zeros(batch.num_rows) for _ in range(3))
            left = np.ones(batch.num_rows, bool)
            for k in range(order, -1, -1):
                n, total, distinct, shorter = (batch.column(f"{c}_{k}").to_numpy().astype(np.float64)
                                               for c in ("n", "total", "distinct", "shorter"))
                all_left, symbols_left = total - ruled_out, distinct - ruled_symbols
                hit = left & (n > 0)
                out[hit] += np.log10(n[hit] / (all_left[hit] + symbols_left[hit]))
                left &= n == 0
                some = left & (symbols_left > 0) & (total > 0)  # see log10_of
                out[some] += np.log10(symbols_left[some] / (all_left[some] + symbols_left[some]))
                known = left & (total > 0)
                ruled_out[known], ruled_symbols[known] = shorter[known], distinct[known]
            out[left] -= np.log10(SYMBOLS - ruled_symbols[left])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out)], ["key", "value"])
    return run


def probabilities(counts: DataFrame, order: int, share: float = 0.0) -> DataFrame:
    """Rows (key, value): log10 of the symbol's probability for every string in rows (key, n).

    Strings with n = 0 are asked for and not trained on. Strings of less than ``share`` of all
    symbols are left out of the trie; 0 keeps all. At most 256 strings share a context or a suffix.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0 if share else 0
    by_order = {order: counts.select("key", "n")}
    for k in range(order - 1, -1, -1):
        by_order[k] = written(by_order[k + 1].groupBy(F.col("key").bitwiseAND(F.lit(_mask(k + 1))).alias("key"))
                              .agg(F.sum("n").alias("n")), "strings")
    below = None
    for k in range(order + 1):
        rows = by_order[k].select("key", F.when(F.col("n") >= share * total, F.col("n")).otherwise(0).alias(f"n_{k}"))
        shorter = F.lit(0).cast("long")
        if below is not None:
            rows = rows.withColumn("suffix", F.col("key").bitwiseAND(F.lit(_mask(k)))).join(
                below.withColumnRenamed("key", "suffix"), "suffix").drop("suffix")
            shorter = F.sum(F.when(F.col(f"n_{k}") > 0, F.col(f"n_{k - 1}")).otherwise(0))
        rows = rows.withColumn("context", F.shiftrightunsigned("key", 8))
        contexts = rows.groupBy("context").agg(
            F.sum(f"n_{k}").alias(f"total_{k}"), F.count_if(F.col(f"n_{k}") > 0).alias(f"distinct_{k}"),
            shorter.alias(f"shorter_{k}"))
        below = written(rows.join(contexts, "context").drop("context"), "trie")
    return below.mapInArrow(_log10(order), "key long, value double")


def trie(orders: list[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
    """Per order the kept strings with what coding needs of their contexts, as plain arrays.

    ``orders[k]``: numbers of the kept strings of k context bytes and a symbol, and their counts.
    """
    levels: list[dict] = []
    for k, (keys, counts) in enumerate(orders):
        place = np.argsort(keys)
        keys, counts = keys[place], counts[place].astype(np.float64)
        contexts, owner = np.unique(keys >> np.uint64(8), return_inverse=True)
        shorter = np.zeros(len(contexts))
        if k:
            at = np.searchsorted(levels[-1]["keys"], keys & np.uint64((1 << (8 * k)) - 1))
            shorter = np.bincount(owner, levels[-1]["counts"][at], len(contexts))
        levels.append({
            "keys": keys, "counts": counts, "owner": owner.astype(np.int32),
            "total": np.bincount(owner, counts, len(contexts)),
            "distinct": np.bincount(owner, minlength=len(contexts)).astype(np.float64),
            "shorter": shorter, "strings": lookup(keys), "contexts": lookup(contexts)})
    return levels


def log10_of(levels: list[dict], strings: np.ndarray) -> np.ndarray:
    """log10 of the probability of each symbol in its context."""
    out = np.zeros(len(strings))
    left = np.arange(len(strings))
    ruled_out, ruled_symbols = np.zeros(len(strings)), np.zeros(len(strings))
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        wanted = strings[left] & np.uint64((1 << (8 * (k + 1))) - 1)
        place = find(level["strings"], wanted)
        hit = place >= 0
        at, mine = place[hit], left[hit]
        context = level["owner"][at]
        out[mine] += np.log10(level["counts"][at] / (
            level["total"][context] - ruled_out[mine] + level["distinct"][context] - ruled_symbols[mine]))
        left = left[~hit]
        context = find(level["contexts"], wanted[~hit] >> np.uint64(8))
        known = context >= 0
        mine, context = left[known], context[known]
        total = level["total"][context] - ruled_out[mine]
        symbols = level["distinct"][context] - ruled_symbols[mine]
        some = symbols > 0   # a context all of whose symbols are ruled out needs no escape
        out[mine[some]] += np.log10(symbols[some] / (total[some] + symbols[some]))
        ruled_out[mine], ruled_symbols[mine] = level["shorter"][context], level["distinct"][context]
    out[left] -= np.log10(SYMBOLS - ruled_symbols[left])
    return out


def trie_of(counts: DataFrame, order: int, share: float) -> list[dict]:
    """The trie of the strings counted in rows (key, n) as arrays, for tables of a bounded size."""
    prefix = F.explode(F.array(*(F.struct(
        F.lit(k).alias("order"), F.col("key").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1)).alias("key"))
        for k in range(order + 1))))
    total = counts.agg(F.sum("n")).first()[0] or 0
    kept = (counts.select(prefix.alias("s"), "n").groupBy("s.order", "s.key").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= share * total).toPandas())   # at most (order + 1) / share rows
    return trie([(part["key"].to_numpy(np.uint64), part["n"].to_numpy(np.int64))
                 for part in (kept[kept["order"] == k] for k in range(order + 1))])


# ---- scores

def _asked(order: int):
    """The distinct strings and words of a bundle."""
    def run(table: pa.Table) -> pa.Table:
        data, offsets = text_bytes(table.column("text"))
        strings, words = Counter(), Counter()
        for a, b in row_blocks(offsets):
            part = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            strings.add(grams(lowered(part[0]), part[1], order)[0])
            words.add(word_hashes(*part)[0])
        words.add(END_WORD)
        found = [(kind, keys) for kind, counter in ((GRAM, strings), (WORD, words)) for keys, _ in counter.columns()]
        kinds = np.concatenate([np.full(len(keys), kind, np.int32) for kind, keys in found])
        return pa.table({"bundle": pa.array(np.full(len(kinds), table.column("bundle")[0].as_py(), np.int64)),
                         "kind": pa.array(kinds), "key": pa.concat_arrays([keys for _, keys in found])})
    return run


def _scored(order: int, total: int, distinct: int, names: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        kinds, all_keys, values = (answers.column(c).to_numpy() for c in ("kind", "key", "value"))
        all_keys = all_keys.view(np.uint64)
        logs_of = lookup(all_keys[kinds == GRAM]), values[kinds == GRAM]
        keys, known = all_keys[kinds == WORD], values[kinds == WORD]
        place = np.argsort(keys)
        keys, known = keys[place], known[place]
        data, offsets = text_bytes(docs.column("text"))
        n_tokens, n_known, base, score = [], [], [], []
        for a, b in row_blocks(offsets):
            part = lowered(data[offsets[a]:offsets[b]]), offsets[a:b + 1] - offsets[a]
            words, firsts = word_hashes(*part)
            # Each text's words, then its end.
            words = np.insert(words, firsts[1:], END_WORD[0])
            firsts = firsts + np.arange(len(firsts))
            c = known[np.searchsorted(keys, words)] if len(words) else np.zeros(0)
            logs = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
            n_tokens.append(np.diff(firsts))
            n_known.append(np.add.reduceat((c > 0).astype(np.int64), firsts[:-1]))
            base.append(np.add.reduceat(logs, firsts[:-1]))
            strings, before = grams(*part, order)
            score.append(np.add.reduceat(logs_of[1][find(logs_of[0], strings)], before[:-1]))
        columns = {n: docs.column(n) for n in names}
        columns |= {"n_tokens": np.concatenate(n_tokens), "n_known": np.concatenate(n_known).astype(np.int64),
                    "train_tokens": np.full(docs.num_rows, total, np.int64),
                    "base_score": np.concatenate(base), "score": np.concatenate(score)}
        return pa.table(columns)
    return run


def scored(docs: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text", order: int = ORDER,
           share: float = 0.0) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score), one per row of ``docs``.

    The rows for which ``held_out`` does not hold are the training texts; a null there
    counts as not held out. A-Z count as a-z throughout. A null text is empty: one
    token, its end. ``base_score`` adds log10((c + 0.5) / (N + 0.5 (V + 1))) over the
    tokens, ``score`` is log10 of the trie model's probability of the bytes and the
    end. Without training texts all counts are 0 and every symbol is equally likely.
    Repeated rows are scored alike and train as often as they occur; a very long text is scored
    and counted whole; no rows give no rows; other columns are ignored. Words are compared by 64-bit hashes.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    def counted(texts: DataFrame) -> DataFrame:
        return texts.select("text").mapInArrow(_count(order), "kind int, key long, n long")

    trained, others = counted(rows.filter(~F.col("held_out"))), counted(rows.filter("held_out"))
    counts = written(trained.unionByName(others.withColumn("n", F.lit(0).cast("long")))
                     .groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = counts.filter(F.col("kind") == WORD).select("key", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    logs = probabilities(counts.filter(F.col("kind") == GRAM), order, share)
    known = logs.select(F.lit(GRAM).alias("kind"), "key", "value").unionByName(
        words.select(F.lit(WORD).alias("kind"), "key", F.col("n").cast("double").alias("value")))

    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bundles = math.ceil(size / BUNDLE_BYTES) or 1
    bundled = (rows.withColumn("bundle", F.pmod(F.xxhash64("id", "text"), F.lit(bundles)))
               .repartition(bundles, "bundle"))
    asked = bundled.groupBy("bundle").applyInArrow(_asked(order), "bundle long, kind int, key long")
    # The counts cover all texts, so every question has its answer.
    answers = asked.join(known, ["kind", "key"]).select("bundle", "kind", "key", "value")
    names = ["id", "held_out"]
    schema = (f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    return (bundled.groupBy("bundle").cogroup(answers.groupBy("bundle"))
            .applyInArrow(_scored(order, total, distinct, names), schema).withColumnRenamed("id", id))
