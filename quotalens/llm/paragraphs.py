"""Substring dedup by paragraph MinHash banding.

Units of a text are its paragraphs (lines that hold a word) and, so that a passage is
found wherever it stands inside other text, passages grown from seeds: of any ``WINDOW`` runs of
``SEED`` words that follow each other the one with the least hash is a seed, so two texts that
share ``SEED + WINDOW - 1`` = 23 words share a seed. Words ignore ASCII case and punctuation.

* Equal units form a class straight away (128 bits of hash, counted with partial sums).
* One paragraph of each class gets ``BANDS`` x ``ROWS`` MinHashes of its five-word shingles (below
  five words the whole line is one shingle, which only its equals share: no bands); at a
  similarity of 0.8 two paragraphs meet in some band with probability 1 - (1 - 0.8**3)**8 = 0.997.
  Bands of paragraphs that meet nobody are dropped after a count; bands with the same members
  are joined once.
* Members of a band are verified by the exact Jaccard similarity of their shingle sets. Inside a
  group links are grown from one member after another against those not reached yet, so a cloud
  of copies costs far less than all pairs and returns a star.
* A band of more than ``GROUP`` words is never one group. Its members are dealt to blocks of that
  size; the largest cloud of the first block gives a pivot, all members are measured against it, and
  as the Jaccard distance is a metric, two members whose distances to the pivot differ by more than
  1 - ``SIMILAR`` cannot be linked. So blocks meet only blocks of the same or the next fifth of the
  distance, and the ball around the pivot, linked already, does not meet itself again. No link
  is lost; each meeting is a group of two blocks.
* Components over all stars are the classes; all of a class but its earliest unit is removed.
* A repeated seed is laid against its earliest place. Seeds of a text that lie against the same
  place make one chain, whose ends grow word by word while both texts agree. Beyond its last seed
  a shared passage has fewer than ``WINDOW`` words, so that many words decide; passages of at
  least ``RUN`` words are reported, each with the place it copies.

Only ids, hashes and spans are shuffled, and the texts twice: to fetch the shingles of the
paragraphs that met and the words around chains. Seeds go by 64 bits: a chance pair of seeds is 12
words, and a passage needs four more that agree. Written tables are deleted once used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotalens.llm.common import (
    discard, flat, id_text, materialize, mix64, ragged_arange, release, steps, words_of)
from quotalens.llm.components import components

SHINGLE = 5
SIMILAR = 0.8
LEAST = 1         # words of a paragraph
BANDS, ROWS = 8, 3
SEED = 12         # words of a seed
WINDOW = 12       # neighbouring runs of words of which one is a seed
RUN = 16          # words of a passage
GROUP = 1 << 19   # words of all members of a band that one task verifies
RINGS = 1 << 16   # rows of ring sizes that are broadcast; more are joined by a shuffle
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))


def _shingles(h: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hash of the n words from each word on (the last n - 1 are not whole)."""
    out = h.copy()
    for k in range(1, n):
        out[:-k] = out[:-k] * _ODD + h[k:]
    return mix64(out)


def _sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.append(np.uint64(0), np.cumsum(values))
    return total[end] - total[begin]


def _lines(raw: np.ndarray, starts: np.ndarray, at: np.ndarray):
    """(first word, word after the last) of every paragraph: words between line ends."""
    newline = np.cumsum(raw == 10)
    line = newline[starts] if len(starts) else np.zeros(0, np.int64)
    head = np.append(True, line[1:] != line[:-1]) if len(line) else np.zeros(0, bool)
    first = at[:-1][at[:-1] < at[1:]]
    head[first] = True
    begin = np.flatnonzero(head)
    return begin, np.append(begin[1:], len(starts))


def _seeds(h: np.ndarray, at: np.ndarray):
    """(first word, hash) of the seeds of each text: least of WINDOW runs."""
    runs = np.maximum(np.diff(at) - SEED + 1, 0)
    begin = np.repeat(at[:-1], runs) + ragged_arange(runs)
    if not len(begin):
        return begin, begin.astype(np.uint64)
    score = _shingles(h, SEED)[begin]
    where = np.arange(len(begin)) + np.repeat(WINDOW * np.arange(1, len(runs) + 1), runs)
    padded = np.zeros(len(begin) + WINDOW * (len(runs) + 1), np.uint64)
    padded[where] = score
    span = np.ones(len(begin), np.int64)  # runs around that this one is the (last) least of
    before, after = np.ones(len(begin), bool), np.ones(len(begin), bool)
    for k in range(1, WINDOW):
        before &= score <= padded[where - k]
        after &= score < padded[where + k]
        span += before
        span += after
    kept = span >= np.minimum(WINDOW, np.repeat(runs, runs))
    return begin[kept], score[kept]


_SEED_ROW = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("word", pa.int32()),
                       ("h", pa.int64())])


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in steps(batches, max_bytes=1 << 20):
        h, _, _, at = words_of(*flat(b.column("text")))
        begin, score = _seeds(h, at)
        doc = np.searchsorted(at, begin, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array(doc)), b.column("row").take(pa.array(doc)),
             pa.array((begin - at[doc]).astype(np.int32)), pa.array(score.view(np.int64))],
            schema=_SEED_ROW)


_UNIT = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64()),
                   ("end", pa.int64()), ("words", pa.int32()), ("h1", pa.int64()),
                   ("h2", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _paragraph_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in steps(batches, max_bytes=1 << 20):
        raw, offs = flat(b.column("text"))
        h, starts, ends, at = words_of(raw, offs)
        if not len(h):
            continue
        chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        two = mix64(h ^ _ODD)
        power = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(h), _ODD)))[:-1]
        inverse = np.multiply.accumulate(np.append(np.uint64(1), np.full(
            len(h), pow(int(_ODD), -1, 1 << 64), np.uint64)))[:-1]
        begin, end = _lines(raw, starts, at)
        keep = end - begin >= LEAST
        begin, end = begin[keep], end[keep]
        doc = np.repeat(np.arange(b.num_rows), np.diff(at))[begin]
        size = (end - begin).astype(np.uint64)
        h1 = mix64(_sums(h * power, begin, end) * inverse[begin] ^ size)
        h2 = mix64(_sums(two * power, begin, end) * inverse[begin] + size)
        long = end - begin >= SHINGLE
        bands = _bands(h, begin[long], end[long])
        lists = pa.ListArray.from_arrays(
            np.append(0, np.cumsum(BANDS * long)).astype(np.int32),
            pa.array(bands.ravel().view(np.int64)))
        base = chars[offs[:-1]][doc]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array(doc)), b.column("row").take(pa.array(doc)),
             pa.array(chars[starts[begin]] - base), pa.array(chars[ends[end - 1]] - base),
             pa.array((end - begin).astype(np.int32)), pa.array(h1.view(np.int64)),
             pa.array(h2.view(np.int64)), lists], schema=_UNIT)


def _bands(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """[units, BANDS] hashes of ROWS MinHashes each, of units of at least SHINGLE words."""
    if not len(begin):
        return np.zeros((0, BANDS), np.uint64)
    shingle = _shingles(h)
    bounds = np.column_stack([begin, end - SHINGLE + 1]).ravel()
    tail = bounds[-1] < len(shingle)
    out = np.zeros((len(begin), BANDS), np.uint64)
    for k in range(BANDS * ROWS):
        value = (shingle ^ _SEEDS[k]) * _ODD
        value ^= value >> np.uint64(29)
        least = np.minimum.reduceat(value, bounds if tail else bounds[:-1])[::2]
        band = k // ROWS
        out[:, band] = out[:, band] * _ODD + least + np.uint64(k + 1)
    return mix64(out)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted shingle sets of the paragraphs asked for in each text."""
    for b in batches:
        out = {"unit": [], "set": []}
        for text, asked in zip(b.column("text").to_pylist(), b.column("asked").to_pylist()):
            for u in asked:
                raw = np.frombuffer(text[u["start"]:u["end"]].encode(), np.uint8)
                h = words_of(raw, np.array([0, len(raw)]))[0]
                out["unit"].append(u["unit"])
                out["set"].append(np.unique(_shingles(h)[:len(h) - SHINGLE + 1]).view(np.int64))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("unit", pa.int64()), ("set", pa.list_(pa.int64()))]))


_EDGE = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("word", pa.int32()),
                   ("stop", pa.int32()), ("f_row", pa.int64()), ("f_word", pa.int32()),
                   ("f_stop", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                   ("before", pa.list_(pa.int32())), ("after", pa.list_(pa.int32())),
                   ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the words [word, stop) asked for in each text stand, and the words around them, nearest
    first: hashes, and where the words before start and the words after end. A copy's row carries the
    place it copies (f_), a first place's row has none."""
    for b in steps(batches, max_bytes=1 << 20):
        raw, offs = flat(b.column("text"))
        h, starts, ends, at = words_of(raw, offs)
        short = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
        chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        first, last = chars[starts], chars[ends]
        asked = b.column("asked")
        doc = np.repeat(np.arange(b.num_rows), asked.value_lengths().to_numpy())
        flat_asked = asked.flatten()
        word, stop, *copied = (flat_asked.field(k) for k in range(5))
        word, stop = word.to_numpy(), stop.to_numpy()
        base = chars[offs[:-1]][doc]
        head, tail = at[doc] + word, at[doc] + stop - 1
        n_before = np.minimum(WINDOW - 1, head - at[doc])
        n_after = np.minimum(WINDOW - 1, at[doc + 1] - tail - 1)
        up = np.repeat(head - 1, n_before) - ragged_arange(n_before)
        down = np.repeat(tail + 1, n_after) + ragged_arange(n_after)
        listed = lambda n, values: pa.ListArray.from_arrays(
            np.append(0, np.cumsum(n)).astype(np.int32), pa.array(values.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array(doc)), b.column("row").take(pa.array(doc)),
             pa.array(word), pa.array(stop), *copied, pa.array(first[head] - base), pa.array(last[tail] - base), listed(n_before, short[up]), listed(n_after, short[down]),
             listed(n_before, first[up] - np.repeat(base, n_before)),
             listed(n_after, last[down] - np.repeat(base, n_after))], schema=_EDGE)


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of a group's members: a star around the least unit of each cloud."""
    pdf = pdf.drop_duplicates("unit").sort_values("unit")
    unit = pdf["unit"].to_numpy()
    sizes = np.array([len(s) for s in pdf["set"]])
    begin = np.append(0, np.cumsum(sizes))
    values, code = np.unique(np.concatenate(pdf["set"].to_list()), return_inverse=True)
    order = np.argsort(code, kind="stable")
    post, codes = np.repeat(np.arange(len(unit)), sizes)[order], code[order]  # members by shingle
    at = np.searchsorted(codes, np.arange(len(values) + 1))
    left = np.ones(len(unit), bool)
    listed = remain = len(unit)
    out_a, out_b = [], []
    for centre in range(len(unit)):
        if not left[centre]:
            continue
        left[centre] = False
        remain -= 1
        todo = [centre]
        while todo and remain:
            x = todo.pop()
            if 2 * remain < listed:  # postings keep those not reached yet
                kept = left[post]
                post, codes, listed = post[kept], codes[kept], remain
                at = np.searchsorted(codes, np.arange(len(values) + 1))
            mine = code[begin[x]:begin[x + 1]]
            n = at[mine + 1] - at[mine]
            met = post[np.repeat(at[mine], n) + ragged_arange(n)]
            shared = np.bincount(met, minlength=len(unit))
            found = np.flatnonzero(left & (shared >= SIMILAR * (sizes + sizes[x] - shared)))
            left[found] = False
            remain -= len(found)
            todo.extend(found.tolist())
            out_a.append(unit[found])
            out_b.append(np.full(len(found), unit[centre]))
    if not out_a:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def _links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of the band members ``rows`` (key, unit, size: words of all the key's members)."""
    small = (rows.where(F.col("size") <= GROUP).join(sets, "unit")
             .groupBy("key").applyInPandas(_verify, "a long, b long"))
    large = rows.where(F.col("size") > GROUP)
    if not large.limit(1).count():
        return small
    blocks = F.expr(f"cast(1 + size div {GROUP} as int)")
    large = materialize(large.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("unit"), "blocks").cast("int")).join(sets, "unit"), "hot-bands")
    stars = materialize(large.groupBy("key", "block").applyInPandas(
        _starred, "key long, block int, a long, b long"), "hot-stars")
    # the largest cloud of the first block, a part of the members drawn by hash, gives the pivot
    clouds = stars.where("block = 0").groupBy("key", "b").agg(F.count("*").alias("n"))
    best = clouds.groupBy("key").agg(F.max(F.struct("n", "b"))["b"].alias("cloud"))
    any_unit = large.groupBy("key").agg(F.min("unit").alias("least"), F.first("blocks").alias("blocks"))
    pivot = (any_unit.join(best, "key", "left")
             .select("key", "blocks", F.coalesce("cloud", "least").alias("unit")).join(sets, "unit")
             .select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                     F.col("unit").alias("pivot"), F.col("set").alias("pivot_set")))
    measured = large.join(pivot, ["key", "block"]).withColumn(
        "shared", F.size(F.array_intersect("set", "pivot_set"))).withColumn(
        "all", F.size("set") + F.size("pivot_set") - F.col("shared"))
    measured = materialize(measured.select(
        "key", "unit", "set", "pivot", (F.col("shared") >= SIMILAR * F.col("all")).alias("near"),
        F.expr("cast(5 * (all - shared) div all as int)").alias("ring")), "hot-rings")
    rings = measured.groupBy("key", "ring").agg(F.sum(F.size("set")).alias("words")).select(
        "key", "ring", F.expr(f"cast(1 + words div {GROUP} as int)").alias("parts"))
    near = rings.select("key", (F.col("ring") - 1).alias("ring"), F.col("parts").alias("above"))
    below = rings.select("key", (F.col("ring") + 1).alias("ring"), F.col("parts").alias("below"))
    rings = rings.join(near, ["key", "ring"], "left").join(below, ["key", "ring"], "left").fillna(
        0, ["above", "below"])
    placed = measured.join(F.broadcast(rings), ["key", "ring"]) if rings.limit(RINGS + 1).count() <= RINGS \
        else measured.join(rings, ["key", "ring"])
    placed = placed.withColumn("part", F.pmod(F.xxhash64("unit"), "parts").cast("int"))
    meeting = lambda low, i, high, j: F.struct(
        low.cast("int").alias("low"), i.cast("int").alias("i"), high.cast("int").alias("high"), j.cast("int").alias("j"))
    ring, part = F.col("ring"), F.col("part")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    none = F.array().cast("array<struct<low:int,i:int,high:int,j:int>>")
    placed = placed.withColumn("meeting", F.explode(F.concat(
        F.when(ring > 0, F.transform(upto("parts"), lambda k: meeting(
            ring, F.least(part, k), ring, F.greatest(part, k)))).otherwise(none),
        F.when(F.col("above") > 0, F.transform(upto("above"), lambda k: meeting(
            ring, part, ring + 1, k))).otherwise(none),
        F.when(F.col("below") > 0, F.transform(upto("below"), lambda k: meeting(
            ring - 1, k, ring, part))).otherwise(none))))
    across = placed.select("key", "meeting", "unit", "set").groupBy("key", "meeting").applyInPandas(
        _verify, "a long, b long")
    return small.union(stars.select("a", "b")).union(
        measured.where("near").select(F.col("unit").alias("a"), F.col("pivot").alias("b"))).union(across)


def _starred(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    out = _verify(pdf)
    out.insert(0, "block", np.int32(key[1]))
    out.insert(0, "key", key[0])
    return out


def repeated_units(docs: DataFrame) -> DataFrame:
    """Units that repeat: doc_id, level (0 paragraph, 1 passage), start, end (code points), words,
    class_id, removed (false for the class's earliest unit by doc_id and start).

    Units of no class are not returned: a document without repeats gives no rows. Null texts are
    empty, null ids sort first, repeated rows are copies of each other, other columns are ignored.
    """
    docs = _numbered(id_text(docs))
    passages = _passages(docs)
    units = materialize(docs.mapInArrow(
        _paragraph_rows, "doc long, row long, start long, end long, words int, h1 long, h2 long, "
                         "bands array<long>"), "paragraphs")
    plain = units.drop("bands")
    # one paragraph of each class of equal ones meets others in bands
    lead = units.groupBy("h1", "h2").agg(
        F.count("*").alias("n"),
        F.min(F.struct("doc", "row", "start", "end", "words", "bands")).alias("u"))
    lead = materialize(lead.select("h1", "h2", "n", "u.*", F.monotonically_increasing_id().alias("unit")),
                       "lead-paragraphs")
    release(docs.sparkSession)
    bands = lead.select("unit", "words", F.explode("bands").alias("key"))
    met = bands.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("words").alias("size"),
        F.bit_xor(F.xxhash64("unit")).alias("members"))
    met = met.where(F.col("n") > 1).groupBy("n", "members").agg(
        F.min("key").alias("key"), F.first("size").alias("size")).select("key", "size")
    rows = materialize(bands.select("key", "unit").join(met.hint("shuffle_hash"), "key"), "bands")
    release(docs.sparkSession)
    asked = (lead.join(rows.select("unit").distinct(), "unit", "left_semi")
             .groupBy("row").agg(F.collect_list(F.struct("unit", "start", "end")).alias("asked")))
    sets = (docs.join(asked, "row").select("text", "asked")
            .mapInArrow(_sets, "unit long, set array<long>"))
    sets = materialize(sets, "shingle-sets")
    release(docs.sparkSession)
    links = materialize(_links(rows, sets), "links")
    discard(rows, sets)
    found = materialize(components(links), "paragraph-classes")
    near = lead.join(found, lead["unit"] == found["node"]).select(
        "h1", "h2", F.col("component").alias("near_class"))
    equal = lead.where(F.col("n") > 1).select("h1", "h2", F.lit(None).cast("long").alias("near_class"))
    classes = equal.union(near).groupBy("h1", "h2").agg(F.max("near_class").alias("near_class"))
    member = plain.join(classes.hint("shuffle_hash"), ["h1", "h2"]).withColumn("level", F.lit(0))
    member = member.withColumn("class_id", F.when(
        F.col("near_class").isNotNull(), F.concat(F.lit("n"), F.col("near_class")))
        .otherwise(F.concat("level", F.lit("-"), F.hex("h1"), F.hex("h2"))))
    member = materialize(member.drop("h1", "h2"), "members")
    discard(units, lead)
    first = member.groupBy("class_id").agg(F.min(F.struct("doc", "row", "start")).alias("first"))
    return member.join(first, "class_id").select(
        F.col("doc").alias("doc_id"), "level", "start", "end", "words", "class_id",
        (~F.struct("doc", "row", "start").eqNullSafe(F.col("first"))).alias("removed")).union(passages)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row: the id, or where ids repeat or miss a written number."""
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where(
        (F.col("n") > 1) | F.col("doc_id").isNull()).limit(1).count()
    if repeated:
        return materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    return docs.withColumn("row", F.col("doc_id"))


def _passages(docs: DataFrame) -> DataFrame:
    """Rows of passages: chains of repeated seeds, grown to the maximal match with the place their
    seeds stand first, and those places."""
    seeds = materialize(docs.mapInArrow(_seed_rows, "doc long, row long, word int, h long"), "seeds")
    many = seeds.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("h")
    many = materialize(seeds.join(many.hint("shuffle_hash"), "h", "left_semi"), "repeated-seeds")
    discard(seeds)
    first = many.groupBy("h").agg(F.min(F.struct("doc", "row", "word")).alias("f"))
    copies = many.join(first.hint("shuffle_hash"), "h").where(
        (F.col("row") != F.col("f.row")) | (F.col("word") != F.col("f.word")))
    order = Window.partitionBy("row").orderBy("word")
    shift = F.col("word") - F.col("f.word")
    same = ((F.lag("f.row").over(order) == F.col("f.row")) & (F.lag(shift).over(order) == shift)
            & (F.col("word") - F.lag("word").over(order) <= SEED))
    copies = copies.withColumn("new", F.when(same, 0).otherwise(1))
    copies = copies.withColumn("chain", F.sum("new").over(order))
    chains = materialize(copies.groupBy("row", "chain").agg(
        F.min("word").alias("word"), (F.max("word") + SEED).alias("stop"),
        F.min("f.row").alias("f_row"), F.min("f.word").alias("f_word"),
        (F.max("f.word") + SEED).alias("f_stop")).drop("chain"), "chains")
    discard(many)
    place = chains.select("f_row", "f_word", "f_stop").distinct().select(
        F.col("f_row").alias("row"), F.col("f_word").alias("word"), F.col("f_stop").alias("stop"),
        F.lit(None).cast("long").alias("f_row"), F.lit(None).cast("int").alias("f_word"),
        F.lit(None).cast("int").alias("f_stop"))
    asked = chains.unionByName(place).groupBy("row").agg(
        F.collect_list(F.struct("word", "stop", "f_row", "f_word", "f_stop")).alias("asked"))
    edges = materialize(docs.join(asked, "row").select("doc_id", "row", "text", "asked").mapInArrow(
        _edges, "doc long, row long, word int, stop int, f_row long, f_word int, f_stop int, "
                "start long, end long, before array<int>, after array<int>, starts array<int>, "
                "ends array<int>"), "edges")
    discard(chains)
    sides = ("doc", "start", "end", "before", "after", "starts", "ends")
    there = edges.where(F.col("f_row").isNull()).select(
        F.col("row").alias("f_row"), F.col("word").alias("f_word"), F.col("stop").alias("f_stop"),
        *(F.col(c).alias(f"f_{c}") for c in sides))
    both = edges.where(F.col("f_row").isNotNull()).drop("row").join(there, ["f_row", "f_word", "f_stop"])

    def agree(side: str):
        hits = F.zip_with(side, f"f_{side}", lambda x, y: F.coalesce(x == y, F.lit(False)))
        miss = F.array_position(hits, False)
        return F.when(miss > 0, miss - 1).otherwise(F.size(hits)).cast("int")

    both = both.withColumn("up", agree("before")).withColumn("down", agree("after"))
    grown = lambda name, count, to: F.coalesce(
        F.get(name, F.col(count) - 1).cast("long"), F.col(to))
    both = both.select(
        "doc", grown("starts", "up", "start").alias("start"), grown("ends", "down", "end").alias("end"),
        (F.col("stop") - F.col("word") + F.col("up") + F.col("down")).cast("int").alias("words"), "f_doc", "f_row",
        grown("f_starts", "up", "f_start").alias("f_start"), grown("f_ends", "down", "f_end").alias("f_end"))
    both = materialize(both.where(F.col("words") >= RUN).withColumn(
        "class_id", F.concat_ws("-", F.lit("1"), "f_row", "f_start", "f_end")), "passages")
    discard(edges)
    level = F.lit(1).alias("level")
    return both.select(F.col("doc").alias("doc_id"), level, "start", "end", "words", "class_id",
                       F.lit(True).alias("removed")).union(
        both.select("f_doc", level, "f_start", "f_end", "words", "class_id",
                    F.lit(False).alias("removed")).distinct())


def op1(docs: DataFrame) -> DataFrame:
    return repeated_units(docs)
