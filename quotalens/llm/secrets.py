"""Secret scans: every rule in one pass of a combined deterministic automaton.

The automaton is compiled on the driver (a few hundred states) and shipped with the task; each
Arrow batch is scanned in place, so there is no shuffle. The scan says where matches end; the
few hits are then placed by small automata of their rule (leftmost, longest, not overlapping).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.automaton import Rule, Scanner
from quotalens.llm.common import flat, id_text, steps

# The kinds in the order in which equal starts are listed.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
         "[A-Za-z0-9+/_.=-]+", 6, whole=False, fold=True),
    Rule("access", "AKIA", "[A-Z0-9]+", 20),
    Rule("hex", "", "[0-9a-f]{24,}", 24),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]+", 36),
    Rule("pem", "-----BEGIN [A-Z ]*", "PRIVATE KEY-----", 27),
)
BASE = 3


def find(scanner: Scanner, texts: pa.Array) -> dict[int, list[tuple[int, int, int]]]:
    """Row -> sorted (start, rule, end) in code points, rows without secrets left out."""
    raw, offs = flat(texts)
    n = len(offs) - 1
    joined = np.full(len(raw) + n, 10, np.uint8)
    joined[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(offs))] = raw
    where, state = scanner.hits(joined)
    if not len(where):
        return {}
    reset = np.zeros(256, bool)
    reset[scanner.search.resets] = True
    cuts = np.flatnonzero(reset[joined])
    piece = np.searchsorted(cuts, where)  # the stretch between two resets
    bits = scanner.search.accepts[state]
    begin = offs[:-1] + np.arange(n)
    found: dict[int, list] = {}
    for rule in range(len(scanner.rules)):
        for k in np.unique(piece[bits >> rule & 1 == 1]):
            low, high = int(cuts[k - 1]) + 1 if k else 0, int(cuts[k])
            matches = scanner.place(rule, joined[low:high].tobytes())
            if matches:
                row = int(np.searchsorted(begin, low, "right")) - 1
                found.setdefault(row, []).extend(
                    (low - int(begin[row]) + s, rule, low - int(begin[row]) + e)
                    for s, e in matches)
    for row, spans in found.items():
        text = raw[offs[row]:offs[row + 1]]
        chars = np.append(0, np.cumsum((text & 0xC0) != 0x80))
        found[row] = sorted((int(chars[s]), r, int(chars[e])) for s, r, e in spans)
    return found


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: doc_id, spans array<struct<kind, start, end>> (code points).

    Null texts are empty and have no spans; null, repeated ids and extra columns do no harm.
    """
    scanner = Scanner(list(rules))
    kinds = [r.kind for r in rules]
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            found = find(scanner, b.column("text"))
            spans = [[{"kind": kinds[r], "start": s, "end": e} for s, r, e in found.get(i, ())]
                     for i in range(b.num_rows)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "spans": spans},
                                             schema=schema)

    return id_text(docs).mapInArrow(
        run, "doc_id long, spans array<struct<kind string, start long, end long>>")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every stretch covered by secrets replaced by ``mark``; null texts stay."""
    scanner = Scanner(list(rules))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            column = b.column("text")
            found = find(scanner, column)
            if not found:
                yield b
                continue
            texts = column.to_pylist()
            for row, spans in found.items():
                text, out, at = texts[row], [], 0
                for s, _, e in spans:
                    if s >= at:
                        out += [text[at:s], mark]
                    at = max(at, e)
                texts[row] = "".join([*out, text[at:]])
            yield b.set_column(b.schema.get_field_index("text"), b.schema.field("text"),
                               pa.array(texts, column.type))

    out = docs.mapInArrow(run, schema)
    if "n_chars" in docs.columns:  # follows the text
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(schema["n_chars"].dataType))
    return out


def op3(docs: DataFrame) -> DataFrame:
    """Digest of ``scan``: counts of the base kinds, hash of the base spans, all spans."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in RULES[:BASE]]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in RULES[:BASE]),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
