"""Spelling variants: words that differ by one edit, found by the frontier of a trie.

A trie is a table of edges (node, character, what is below). States ``(word, position, node, edits)`` are joined to the edges of their
node, level by level: without an edit a state follows its word, or spends its edit on another child or on leaving a character out; with
an edit it follows its word exactly, and a state that ends where a word ends has found a neighbour.

Near the top of a trie every character has children, so states would multiply. Edits in the second half of a word are
looked for in the trie of words, those in the first half in the trie of reversed words: a state starts in the middle of its word, where
few words are left below its node. A pair is looked for once, from the longer word, or from the one of the smaller character.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import discard, small_batches, utf8, written

#: Runs of letters, and how often a run loses a character.
RUN = "[A-Za-zÀ-ÿ]+"
NOISE = 97
#: Code points of the longest word in the trie; longer ones meet by what is left without a character.
DEEPEST = 40
_DISTINCT = 400_000


def noisy_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``, each word in several rows at most as often as there are batches: runs of letters, A-Z in lower case.

    Where ``NOISE`` divides crc32 of ``id:run``, h, the run loses its character h mod length. A null text has no words, a null id reads as
    empty. Runs are counted in tasks; repeated rows count each.
    """
    import re

    run = re.compile(RUN)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def packed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
            found.clear()
            return out

        for batch in small_batches(batches, text_col):
            for i, raw in zip(batch.column("_id").to_pylist(), utf8(batch.column(text_col)), strict=True):
                start = zlib.crc32(f"{i}:".encode())
                for word, n in Counter(run.findall(raw.lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % NOISE == 0:
                        h %= len(word)
                        word = word[:h] + word[h + 1 :]
                    found[word] += n
                if len(found) > _DISTINCT:
                    yield packed()
        if found:
            yield packed()

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id")
    return df.select(ids, F.col(text_col).alias(text_col)).mapInArrow(count, "word string, n long")


def _marks(c: Column) -> Column:
    """One of 64 bits for a character; the end of a word has its own."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.when(c == "", 63).otherwise(F.ascii(c) % 63).cast("int"))


def _char(word: Column, at: Column) -> Column:
    """Character ``at`` (from 0) behind the mark of the direction; empty behind the end."""
    return F.substring(word, at + 2, F.lit(1))


def _both_ways(words: DataFrame) -> DataFrame:
    """``(w, size, start)``: each word forwards and backwards behind a mark, and the position of its first edit in that direction."""
    size, half = F.char_length("word"), F.floor(F.char_length("word") / 2).cast("int")
    ways = F.array(F.struct(F.concat(F.lit(">"), "word").alias("w"), size.alias("size"), half.alias("start")), F.struct(F.concat(F.lit("<"), F.reverse("word")).alias("w"), size.alias("size"), (size - half).alias("start")))
    return words.select(F.inline(ways))


def trie_edges(ways: DataFrame, top: int) -> DataFrame:
    """``(depth, node, ch, words, below, only)`` of all nodes from depth ``top`` on that have several words below.

    A node is its prefix. ``ch`` is empty where a word ends. ``below`` marks which characters follow in the child, ``only`` is the hash of its word if it has but one.
    """
    step = ways.select("w", F.explode(F.sequence(F.lit(top), F.greatest(F.lit(top), "size"))).alias("depth")).filter(F.char_length("w") > F.col("depth"))
    rows = step.select("depth", F.substring("w", F.lit(1), F.col("depth") + 1).alias("node"), _char(F.col("w"), F.col("depth")).alias("ch"), _marks(_char(F.col("w"), F.col("depth") + 1)).alias("mark"), F.xxhash64("w").alias("hash"))
    edges = rows.groupBy("depth", "node", "ch").agg(F.count("*").alias("words"), F.bit_or("mark").alias("below"), F.max("hash").alias("only"))
    several = edges.withColumn("_all", F.sum("words").over(W.partitionBy("depth", "node"))).filter("_all > 1").drop("_all")
    return several.sortWithinPartitions("depth")


def _next_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """``(w, pos, node, edits, found)`` after one more character of the trie; ``node`` is the neighbour where ``found``."""
    w, pos, edits = F.col("w"), F.col("pos"), F.col("edits")
    cur, after = _char(w, pos), _char(w, pos + 1)
    # Of equal characters in a row the last of the word may be left out, so that a shorter word is met once.
    last = F.when(w.startswith(">"), cur != after).otherwise(cur != _char(w, pos - 1))
    skip = F.when((edits == 0) & (cur != "") & last, F.array(F.struct((pos + 1).alias("pos"), F.lit(1).alias("edits")))).otherwise(F.array().cast("array<struct<pos:int,edits:int>>"))
    all_of = states.select("w", "node", F.inline(F.concat(F.array(F.struct("pos", "edits")), skip)))
    ch = F.col("ch")
    same = (ch == cur) & ((ch != "") | (edits == 1))
    other = (edits == 0) & (ch != "") & (cur != "") & (ch > cur)
    child = F.concat("node", "ch")
    used = F.when(same, edits).otherwise(1)
    whole = F.when(ch == "", F.col("node")).otherwise(F.concat(child, F.substring(w, pos + 3, F.char_length("w"))))
    found = (used == 1) & ((ch == "") | ((F.col("words") == 1) & (F.col("only") == F.xxhash64(whole))))
    alive = (ch != "") & (F.col("words") > 1) & ((used == 0) | (F.col("below").bitwiseAND(_marks(after)) != 0))
    moved = all_of.join(edges, "node").filter((same | other) & (found | alive))
    return moved.select("w", (pos + 1).alias("pos"), F.when(found, whole).otherwise(child).alias("node"), used.alias("edits"), found.alias("found"))


def _trie_pairs(words: DataFrame) -> list[DataFrame]:
    """Tables of states; those with ``found`` hold the pairs of near words."""
    ways = written(_both_ways(words), "ways")
    spread = {r.start for r in ways.select("start").distinct().collect()}  # at most DEEPEST values
    if not spread:
        discard(ways)
        return []
    edges = written(trie_edges(ways, min(spread)), "edges")
    tables: list[DataFrame] = []
    for depth in range(min(spread), DEEPEST + 1):
        states = [tables[-1].filter("NOT found").drop("found")] if tables else []
        if depth in spread:
            states.append(ways.filter(F.col("start") == depth).select("w", F.lit(depth).alias("pos"), F.substring("w", 1, depth + 1).alias("node"), F.lit(0).alias("edits")))
        elif not states or states[0].isEmpty():
            if depth > max(spread):
                break
            continue
        both = states[0] if len(states) == 1 else states[0].unionByName(states[1])
        tables.append(written(_next_level(both, edges.filter(F.col("depth") == depth).drop("depth")), "states"))
    discard(ways, edges)
    return tables


def _long_pairs(words: DataFrame) -> DataFrame:
    """``(a, b)``, near words of which one is longer than ``DEEPEST``: they agree without a character, or with a gap for it. Groups are as small as the alphabet, since words with one gap in the same place differ only there."""
    long = words.filter(F.char_length("word") >= DEEPEST).select("word", F.char_length("word").alias("size"))
    at = long.select("word", "size", F.explode(F.sequence(F.lit(1), "size")).alias("i"))
    head, tail = F.substring("word", F.lit(1), F.col("i") - 1), F.substring("word", F.col("i") + 1, F.col("size"))
    gaps = at.select("word", F.md5(F.concat(head, F.lit("*"), tail)).alias("key"))
    cuts = at.select("word", F.md5(F.concat(head, tail)).alias("key")).distinct()
    whole = long.select(F.col("word").alias("other"), F.md5("word").alias("key"))
    replaced = gaps.join(gaps.withColumnRenamed("word", "other"), "key").filter("word < other")
    pairs = replaced.select("word", "other").unionByName(cuts.join(whole, "key").select("word", "other"))
    sure = (F.greatest(F.char_length("word"), F.char_length("other")) > DEEPEST) & (F.levenshtein("word", "other", 1) == 1)
    return pairs.filter(sure).select(F.col("word").alias("a"), F.col("other").alias("b"))


def near_words(words: DataFrame) -> DataFrame:
    """``(a, b)``: each pair of words that differ by one inserted, deleted or replaced code point, once. ``words`` has distinct values of ``word``; nulls and empty words are near to nothing."""
    words = words.select("word").filter("word <> ''")
    states = _trie_pairs(words.filter(F.char_length("word") <= DEEPEST))
    pairs = _long_pairs(words)
    for df in states:
        plain = [F.when(F.startswith(F.col(c), F.lit(">")), F.substring(c, 2, DEEPEST + 1)).otherwise(F.reverse(F.substring(c, 2, DEEPEST + 1))).alias(k) for k, c in (("a", "w"), ("b", "node"))]
        pairs = pairs.unionByName(df.filter("found").select(*plain))
    out = written(pairs, "near")
    discard(*states)
    return out


def _roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)`` without circles: each round follows twice as many forms."""
    now = written(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.filter("moved").isEmpty():
        on = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        last, now = now, written(now.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        discard(last)
    return now.select("word", "root")


def group_spellings(counts: DataFrame, ratio: float = 2.0) -> DataFrame:
    """``(word, n, form, form_n, root, n_near)`` from distinct ``(word, n)``.

    ``form`` is the near word of largest n (ties: the smallest by code point) if its n is at least ``ratio`` times the word's; ``root``
    follows forms to the last one, the word itself without any; n grows along forms, so there are no circles. ``n_near`` counts near words. Other columns play no part.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    counts = counts.select("word", "n")
    pairs = near_words(counts)
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = sides.join(counts.select(F.col("word").alias("b"), F.col("n").alias("_n")), "b")
    best = other.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("_n")).alias("m"), F.col("b").alias("w"))).alias("_best"))
    takes = -F.col("_best.m") >= ratio * F.col("n")
    formed = counts.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(takes, F.col("_best.w")).alias("form"), F.when(takes, -F.col("_best.m")).alias("form_n"))
    formed = written(formed, "forms")
    discard(pairs)
    out = formed.join(_roots(formed.filter("form IS NOT NULL")), "word", "left")
    return out.select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")


def spelling_variants(docs: DataFrame, least_size: int = 5, least_n: int = 3, ratio: float = 2.0) -> DataFrame:
    """Words of ``docs`` (see :func:`noisy_words`) of ``least_size`` code points and ``least_n`` occurrences at least, as in :func:`group_spellings`. An empty table gives no rows."""
    counts = noisy_words(docs).groupBy("word").agg(F.sum("n").alias("n")).filter((F.char_length("word") >= least_size) & (F.col("n") >= least_n))
    return group_spellings(written(counts, "words"), ratio)


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every word; null texts have no words."""
    out = spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
