"""SentencePiece encoding and decoding by a batched numpy Viterbi pass.

Words of one length advance together: at every end position the hashes of all substrings that
end there probe the sorted keys of the pieces, and a vectorised maximum over the piece lengths
stores the best last piece of each prefix as its backpointer.

For unigram models the step's value is the sum of piece scores. For models of the merge kind a
sum of scores does not give the model's own segmentation, so the step there asks whether the
new piece and the last piece of the shorter prefix may stand side by side (merging their
characters again must give just these two pieces); exactly one last piece of each prefix can,
so the same pass gives the library's ids. A text is cut first where no piece can reach across:
at spaces, at characters without a piece (byte pieces), and between characters that no piece
has side by side.

The model file is read on the driver; its tables, bounded by the vocabulary, go out as a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import ragged_arange, steps

SPACE = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
TOP = np.uint64(44)     # 20 bits of a key probe the bit table
WHOLE = 64             # a longer word is cut wherever no piece reaches across
KEEP_WORDS = 400_000  # cache entries a task keeps; a cache only


def _hash(points: np.ndarray) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in points:
            h = h * BASE + np.uint64(p) + np.uint64(1)
    return h


class Lookup:
    """Places of sorted uint64 keys, by a table over their top bits; keys that share them are searched."""

    def __init__(self, keys: np.ndarray):
        shared = np.bincount((keys >> TOP).astype(np.int64), minlength=1 << 20)
        self.keys, self.maybe, self.crowded = keys, shared > 0, shared > 1
        self.begins = (np.cumsum(shared) - shared).astype(np.int32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``wanted`` are keys, their places)."""
        top = (wanted >> TOP).astype(np.int64)
        some = np.flatnonzero(self.maybe[top])
        found, top = wanted[some], top[some]
        at = self.begins[top]
        more = np.flatnonzero(self.crowded[top])
        at[more] = np.minimum(np.searchsorted(self.keys, found[more]), len(self.keys) - 1)
        same = self.keys[at] == found
        return some[same], at[same]


def _mixed(pair_keys: np.ndarray) -> np.ndarray:
    """Pair keys spread over 64 bits, one to one."""
    return pair_keys.astype(np.uint64) * BASE


@dataclass
class Vocabulary:
    """Tables of a model; ``rank`` orders pieces by merge (single characters first)."""

    merges: bool
    texts: list[str]               # by id; byte pieces as one character "\x00".."\xff" in raw
    raw: list[bytes]               # by id, what a piece decodes to
    keys: Lookup                   # hashes of usable pieces
    key_ids: np.ndarray
    scores: np.ndarray             # by id
    longest: int
    bytes_ids: list[int]           # id of byte piece b
    chars: set[str]
    inside: set[str]               # pairs of characters that some piece has side by side
    unknown: float
    rank: np.ndarray = field(default=None)
    left: np.ndarray = field(default=None)     # rank of each rank's left part (itself: single)
    right: np.ndarray = field(default=None)
    pair_keys: Lookup = field(default=None)        # mixed keys of two ranks that merge
    pair_rank: np.ndarray = field(default=None)
    by_rank: np.ndarray = field(default=None)  # id of each rank


def load(path: str) -> Vocabulary:
    """Vocabulary of a model file, read with the sentencepiece library on the driver."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    assert sentencepiece.SentencePieceProcessor(model_file=path).vocab_size() == len(model.pieces)
    rows = [(p.piece, p.score, p.type) for p in model.pieces]
    return build(rows, merges=model.trainer_spec.model_type == 2)


def build(rows: list[tuple[str, float, int]], merges: bool) -> Vocabulary:
    """Vocabulary of (piece, score, type) rows; types as in model files (1 normal, 6 byte)."""
    texts = [r[0] for r in rows]
    usable = {t: i for i, (t, _, kind) in enumerate(rows) if kind in (1, 4) and t}
    bytes_ids = [-1] * 256
    raw = []
    for i, (t, _, kind) in enumerate(rows):
        if kind == 6:
            bytes_ids[int(t[1:-1], 16)] = i
            raw.append(bytes([int(t[1:-1], 16)]))
        else:
            raw.append(t.replace(SPACE, " ").encode() if kind in (1, 4) else b"")
    scores = np.array([r[1] for r in rows], np.float64)
    split: dict[str, tuple[str, str]] = {}
    if merges:  # keep pieces that merging their own characters gives
        for t in list(usable):
            if len(t) > 1:
                parts = _merge(list(t), usable, scores, float(scores[usable[t]]))
                if len(parts) == 2:
                    split[t] = (parts[0], parts[1])
                elif not t.strip(SPACE):
                    continue
                else:
                    del usable[t]
    keyed = {t: i for t, i in usable.items() if not (merges and len(t) > 1 and t not in split)}
    keys = np.array([_hash(np.array([ord(c) for c in t], np.uint64)) for t in keyed], np.uint64)
    ids = np.array(list(keyed.values()), np.int64)
    order = np.argsort(keys)
    if len(np.unique(keys)) != len(keys):
        raise ValueError("two pieces share a hash")
    v = Vocabulary(merges, texts, raw, Lookup(keys[order]), ids[order], scores,
                   max((len(t) for t in keyed), default=1), bytes_ids,
                   {t for t in usable if len(t) == 1},
                   {t[i:i + 2] for t in usable for i in range(len(t) - 1)},
                   float(scores.min(initial=0)) - 10)
    if merges:
        single = [t for t in keyed if len(t) == 1]
        double = sorted((t for t in keyed if len(t) > 1), key=lambda t: (-scores[keyed[t]], keyed[t]))
        at = {t: r for r, t in enumerate(single + double)}
        v.by_rank = np.array([keyed[t] for t in at], np.int64)
        v.rank = np.full(len(rows), -1, np.int64)
        v.rank[v.by_rank] = np.arange(len(at))
        v.left = np.array([at[split[t][0]] if t in split else r for t, r in at.items()], np.int64)
        v.right = np.array([at[split[t][1]] if t in split else r for t, r in at.items()], np.int64)
        pairs = {at[t[:k]] * len(at) + at[t[k:]]: r for t, r in at.items() for k in range(1, len(t))
                 if t[:k] in at and t[k:] in at}
        mixed = _mixed(np.array(list(pairs), np.int64))
        order = np.argsort(mixed)
        v.pair_keys = Lookup(mixed[order])
        v.pair_rank = np.array(list(pairs.values()), np.int64)[order]
    return v


def _merge(parts: list[str], usable: dict, scores: np.ndarray, above: float) -> list[str]:
    """Best-scoring merges first, leftmost of equals, only merges that score above ``above``."""
    while len(parts) > 1:
        best, where = above, -1
        for k in range(len(parts) - 1):
            i = usable.get(parts[k] + parts[k + 1])
            if i is not None and scores[i] > best:
                best, where = scores[i], k
        if where < 0:
            break
        parts[where:where + 2] = [parts[where] + parts[where + 1]]
    return parts


def _beside(v: Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ranks a and b stay two pieces when their characters are merged anew.

    The later merge of the two is undone again and again; if the inner neighbours would have
    merged before that, the pair cannot stand.
    """
    n = len(v.by_rank)
    out = np.ones(len(a), bool)
    row, limit = np.arange(len(a)), np.full(len(a), 1 << 62, np.int64)
    a, b = a.copy(), b.copy()
    while len(row):
        pair, at = v.pair_keys.find(_mixed(a * n + b))
        clash = np.zeros(len(a), bool)
        clash[pair] = v.pair_rank[at] < limit[pair]
        out[row[clash]] = False
        undo_a = a > b
        stuck_a, stuck_b = v.right[a] == a, v.left[b] == b
        undo_a = np.where(stuck_a, False, np.where(stuck_b, True, undo_a))
        go = ~clash & ~(stuck_a & stuck_b)
        limit = np.where(undo_a, a, b + 1)
        a, b = np.where(undo_a, v.right[a], a), np.where(undo_a, b, v.left[b])
        row, a, b, limit = row[go], a[go], b[go], limit[go]
    return out


def encode_equal(v: Vocabulary, points: np.ndarray) -> list[np.ndarray]:
    """Ids of words of one length, given as a matrix of code points that all have pieces."""
    ids, counts = _encode_equal(v, points)
    return np.split(ids, np.cumsum(counts)[:-1])


def _encode_equal(v: Vocabulary, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The int32 ids of all words end to end, and their number per word."""
    n, size = points.shape
    wide = min(v.longest, size)
    hashed = np.zeros((size + 1, n), np.uint64)
    power = np.ones(wide + 1, np.uint64)
    for k in range(1, wide + 1):
        power[k:k + 1] = power[k - 1:k] * BASE
    for k in range(size):
        hashed[k + 1] = hashed[k] * BASE + points[:, k].astype(np.uint64) + np.uint64(1)
    best = np.full((size + 1, n), -np.inf)
    best[0] = 0
    last = np.full((size + 1, n), -1, np.int64)
    took = np.zeros((size + 1, n), np.int64)
    rows = np.arange(n)
    for end in range(1, size + 1):
        lengths = np.arange(1, min(end, wide) + 1)
        probe = hashed[end] - hashed[end - lengths] * power[lengths, None]
        hit, at = v.keys.find(probe.ravel())
        row, begin, found = hit % n, end - 1 - hit // n, v.key_ids[at]
        score = best[begin, row]
        if v.merges:
            open_ = np.flatnonzero((score > -np.inf) & (begin > 0))
            fits = _beside(v, v.rank[last[begin[open_], row[open_]]], v.rank[found[open_]])
            score[open_[~fits]] = -np.inf
        else:
            score = score + v.scores[found]
        ids, value = np.full(probe.shape, -1, np.int64), np.full(probe.shape, -np.inf)
        ids.ravel()[hit], value.ravel()[hit] = found, score
        pick = value.argmax(axis=0)
        best[end], last[end], took[end] = value[pick, rows], ids[pick, rows], lengths[pick]
    at, used = np.full(n, size), np.zeros((size + 1, n), bool)
    for end in range(size, 0, -1):
        used[end] = at == end
        at -= np.where(used[end], took[end], 0)
    return last.T[used.T].astype(np.int32), used.sum(axis=0)  # row by row: pieces from the left


class Encoder:
    """Text to ids and back; keeps the ids of words it has seen."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.known: dict[str, bytes] = {}
        self.runs: dict[int, bytes] = {}
        self.lone = _ids([v.texts.index(SPACE)]) if SPACE in v.chars else b""
        self.sizes = np.array([len(r) for r in v.raw], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.all = np.frombuffer(b"".join(v.raw), np.uint8)

    def _cut(self, word: str) -> list[tuple[str, bool]]:
        """(stretch, has pieces): no piece reaches across two stretches."""
        chars, inside, out, at = self.v.chars, self.v.inside, [], 0
        if len(word) <= WHOLE:
            if chars.issuperset(word):
                return [(word, True)]
            if "\n" in word:  # the commonest character without a piece
                for k, part in enumerate(word.split("\n")):
                    out += [("\n", "\n" in chars)] * (k > 0) + (self._cut(part) if part else [])
                return out
        for i in range(1, len(word) + 1):
            if i == len(word) or word[i - 1:i + 1] not in inside:
                part = word[at:i]
                out.append((part, part[0] in chars) if len(part) == 1 else (part, True))
                at = i
        return out

    def learn(self, words) -> None:
        """Encode words (with their leading space mark) that are not known yet."""
        self.known.update(self._learned(words))

    def _learned(self, words) -> dict[str, bytes]:
        """Ids by word, in the order of ``words``."""
        cuts = {w: self._cut(w) for w in words}
        need: dict[int, set] = {}
        for parts in cuts.values():
            for part, ok in parts:
                if ok:
                    need.setdefault(len(part), set()).add(part)
        made: dict[str, bytes] = {}
        for size, group in need.items():
            group = list(group)
            for i in range(0, len(group), 8192):
                own = group[i:i + 8192]
                points = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32).reshape(-1, size)
                ids, counts = _encode_equal(self.v, points)
                ids, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
                made.update(zip(own, [ids[a:b] for a, b in zip([0, *ends], ends)]))
        spell = self.v.bytes_ids
        return {w: made[parts[0][0]] if len(parts) == 1 and parts[0][1]
                else b"".join([made[p] if ok else _ids([spell[b] for b in p.encode()]) for p, ok in parts])
                for w, parts in cuts.items()}

    def _run(self, n: int) -> bytes:
        """Ids of n space marks alone; a long run is whole longest pieces, then the rest."""
        if n not in self.runs:
            v = self.v
            if v.merges:
                usable = {t: i for i, t in enumerate(v.texts) if t and not t.strip(SPACE)}
                top = max(usable, key=len)
                whole = max(0, n // len(top) - 2)
                parts = [top] * whole + _merge([SPACE] * (n - whole * len(top)), usable, v.scores,
                                               -np.inf)
                self.runs[n] = _ids([usable[t] for t in parts])
            else:
                self.runs[n] = _encode_equal(v, np.full((1, n), ord(SPACE)))[0].tobytes()
        return self.runs[n]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32 bytes."""
        split = [t.split(" ") if t else [] for t in texts]
        if len(self.known) > KEEP_WORDS:
            self.known.clear()
        new = set().union(*split) - self.known.keys()
        new.discard("")
        # keys are words without their space mark
        fresh = [w for w in new if SPACE not in w]
        self.known.update(zip(fresh, self._learned([SPACE + w for w in fresh]).values()))
        known, out = self.known, []
        for words, text in zip(split, texts):
            if SPACE in text:
                out.append(self._slow(text))
            elif "" in words:
                out.append(self._spaced(words))
            else:
                out.append(b"".join([known[w] for w in words]))
        return out

    def _spaced(self, words: list[str]) -> bytes:
        out, marks = [], 0
        for w in words:
            if not w:
                marks += 1
                continue
            ids = self.known[w]
            if marks and ids[:4] == self.lone:  # the word's own mark joins the run
                out += [self._run(marks + 1), ids[4:]]
            else:
                out += [self._run(marks) if marks else b"", ids]
            marks = 0
        return b"".join([*out, self._run(marks) if marks else b""])

    def _slow(self, text: str) -> bytes:
        """A text that has the space mark itself: the mark counts as a space."""
        return self.encode([text.replace(SPACE, " ")])[0]

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of id sequences; the leading space is dropped, bad byte runs are replaced."""
        each = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), np.int32)
        sizes = self.sizes[flat]
        whole = self.all[np.repeat(self.begins[flat], sizes) + ragged_arange(sizes)].tobytes()
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(each)]
        begins = np.append(0, ends)[:-1]
        return [(whole[a + 1:b] if whole[a:a + 1] == b" " else whole[a:b]).decode("utf-8", "replace")
                for a, b in zip(begins.tolist(), ends.tolist())]


def _ids(ids) -> bytes:
    return np.array(ids, np.int32).tobytes()


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip (decoding gives the text) per input row.

    A null text is empty; an empty text has no ids. A text that has the mark U+2581 itself
    decodes to spaces there, so its round_trip is false. Other columns are ignored.
    """
    ship = docs.sparkSession.sparkContext.broadcast(load(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(ship.value)
        for b in steps(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            ids = coder.encode(texts)
            same = [x == t for x, t in zip(coder.decode(ids), texts)]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), lists,
                                              pa.array(same)], schema=_SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids are empty."""
    ship = encoded.sparkSession.sparkContext.broadcast(load(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(ship.value)
        for b in batches:
            texts = coder.decode([_ids(x or []) for x in b.column("ids").to_pylist()])
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": texts})

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, text string")


#: Where the public model lies here; a parameter everywhere.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def op7(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    return encode(docs, model_file)
