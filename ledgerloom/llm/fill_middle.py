"""Fill-in-middle texts by displacement scatter.

A text is cut at two hash-random code points into prefix, middle and suffix, which are put into
another order behind marks. Texts of a batch lie one after the other as bytes. A scan finds the
bytes of the cuts; every segment moves as one piece, so the change of shift from a segment to the
next is written at its first byte, and the running sum of these changes is the shift of every byte.
One numpy scatter builds all outputs of the batch. Restoring finds the marks in the outputs,
derives the same shifts from them, and gathers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, query, table
from .shingles import slices

BYTES_AT_ONCE = 1_000_000  # shifts are summed for so many bytes at a time, also inside a long text
FORMS = ("plain", "psm", "spm")


@dataclass(frozen=True)
class Rule:
    """How texts are cut: the seed of the hashes, shares of a hundred, and the marks (three bytes each)."""

    seed: int = 1
    cut_of_100: int = 90
    spm_of_100: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def marks(self) -> np.ndarray:
        made = [x.encode() for x in (self.prefix, self.suffix, self.middle)]
        # Equal ends keep a mark from arising where a segment meets a mark.
        if len(set(made)) != 3 or any(len(m) != 3 or m[0] in m[1:] or m[0] != made[0][0] for m in made):
            raise ValueError("marks are three different strings of three bytes, whose common first byte occurs once in each")
        return np.frombuffer(b"".join(made), np.uint8).reshape(3, 3)


# --- arrays ----------------------------------------------------------------------------------


def byte_of_point(data: np.ndarray, edges: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The byte of ``data`` where code point ``points[i]`` of text i begins; edges[i + 1] for one past its last."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(heads, edges[:-1])
    return np.append(heads, len(data))[first + points]


def shifts(at: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, past, target of each byte) over ``size`` bytes; the segment that begins at ``at[k]`` moves by ``shift[k]``."""
    change = np.diff(shift, prepend=0)
    carry = 0
    for a in range(0, size, BYTES_AT_ONCE):
        b = min(size, a + BYTES_AT_ONCE)
        steps = np.zeros(b - a, np.int64)
        here = slice(*np.searchsorted(at, (a, b)))
        np.add.at(steps, at[here] - a, change[here])  # empty segments begin at the same byte
        steps[0] += carry
        total = np.cumsum(steps)
        carry = int(total[-1])
        yield a, b, total + np.arange(a, b)


def _segments(edges: np.ndarray, p: np.ndarray, q: np.ndarray, out: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and shift of the three segments of every text, and where the marks go in the outputs.

    ``edges`` and ``out`` give the bytes where texts and outputs begin; the segments of text i begin at edges[i], p[i], q[i].
    """
    size_p, size_m, size_s = p - edges[:-1], q - p, edges[1:] - q
    spm, moved = form == 2, form > 0
    at_p = out[:-1] + np.where(spm, 6 + size_s, 3)
    at_s = out[:-1] + np.where(spm, 3, 6 + size_p)
    at_m = out[:-1] + 9 + size_p + size_s
    mark = np.stack((at_p, at_s, at_m), axis=1) - 3
    begin = np.stack((edges[:-1], p, q), axis=1)
    shift = np.where(moved[:, None], np.stack((at_p, at_m, at_s), axis=1) - begin, (out[:-1] - edges[:-1])[:, None])
    return begin.ravel(), shift.ravel(), mark[moved]


def scatter(data: np.ndarray, edges: np.ndarray, p: np.ndarray, q: np.ndarray, form: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes of all texts, and where each output begins. ``p`` and ``q`` are the bytes of the cuts."""
    out = np.concatenate(([0], np.cumsum(np.diff(edges) + 9 * (form > 0))))
    at, shift, mark = _segments(edges, p, q, out, form)
    made = np.empty(out[-1], np.uint8)
    for a, b, target in shifts(at, shift, len(data)):
        made[target] = data[a:b]
    for k in range(3):
        for i in range(3):
            made[mark[:, k] + i] = marks[k, i]
    return made, out


def gather(made: np.ndarray, out: np.ndarray, form: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts from the outputs and their forms alone, and where each begins."""
    moved = form > 0
    own = np.flatnonzero(moved)
    place = np.zeros((len(form), 3), np.int64)
    head = np.flatnonzero(made[:-2] == marks[0, 0]) if len(made) > 2 else np.empty(0, np.int64)
    for k in range(3):
        hit = head[(made[head + 1] == marks[k, 1]) & (made[head + 2] == marks[k, 2])]
        owner = np.searchsorted(out, hit, side="right") - 1
        inside = moved[owner] & (hit + 3 <= out[owner + 1])  # not begun in one output and ended in the next
        hit, owner = hit[inside], owner[inside]
        if not np.array_equal(owner, own):
            raise ValueError("an output without each mark once is not a cut text")
        place[own, k] = hit + 3
    spm = form == 2
    size_p = np.where(spm, place[:, 2] - place[:, 0], place[:, 1] - place[:, 0]) - 3
    size_s = np.where(spm, place[:, 0] - place[:, 1], place[:, 2] - place[:, 1]) - 3
    edges = np.concatenate(([0], np.cumsum(np.diff(out) - 9 * moved)))
    p = np.where(moved, edges[:-1] + size_p, edges[:-1])
    q = np.where(moved, edges[1:] - size_s, edges[:-1])
    at, shift, _ = _segments(edges, p, q, out, form)
    data = np.empty(edges[-1], np.uint8)
    for a, b, source in shifts(at, shift, len(data)):
        data[a:b] = made[source]
    return data, edges


# --- tasks -----------------------------------------------------------------------------------


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    each = [(t or "").encode() for t in column.to_pylist()]
    return np.frombuffer(b"".join(each), np.uint8), np.cumsum([0] + [len(t) for t in each])


def _strings(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    whole = data.tobytes()
    return pa.array([whole[a:b].decode() for a, b in zip(edges[:-1], edges[1:])], pa.string())


def _replaced(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: values if c == column else batch.column(c) for c in batch.schema.names})


def _form(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return np.array([FORMS.index(f or "plain") for f in batch.column(column).to_pylist()], np.int64)


def _scattered(text: str, first: str, second: str, form: str, marks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                data, edges = _bytes_of(batch.column(text))
                p, q = (byte_of_point(data, edges, batch.column(c).to_numpy(zero_copy_only=False)) for c in (first, second))
                yield _replaced(batch, text, _strings(*scatter(data, edges, p, q, _form(batch, form), marks)))

    return run


def _gathered(text: str, form: str, marks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                made, out = _bytes_of(batch.column(text))
                yield _replaced(batch, text, _strings(*gather(made, out, _form(batch, form), marks)))

    return run


# --- operator --------------------------------------------------------------------------------


def _hash_number(digest: Column, group: int) -> Column:
    """The 8-digit group of a hex digest as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def cut_texts(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by its fill-in-middle form, and the columns n (code points),
    form, prefix_chars and middle_chars behind the others.

    * Null texts count as empty; empty texts and texts that hold a mark stay plain, with null lengths.
    * Cuts depend on the seed and the id alone, so rows that share an id are cut at places drawn
      alike, and repeated rows come out alike. A null id counts as an empty string.
    * Texts of any length are handled whole. An empty table gives no rows. All other columns are
      kept; where one has a new column's name already, the new one gets underscores in front.
    """
    marks = rule.marks()
    n, form, prefix, middle, code, first, second = (
        free_name(docs, c) for c in ("n", "form", "prefix_chars", "middle_chars", "_code", "_first", "_second")
    )
    text, length = F.col(f"`{text_col}`"), F.col(n)
    made = docs.withColumn(text_col, F.coalesce(text, F.lit("")))
    seeded = F.concat(F.lit(f"{rule.seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    made = made.withColumn(code, F.sha2(seeded, 256)).withColumn(n, F.length(text).cast("long"))
    marked = F.lit(False)
    for m in (rule.prefix, rule.suffix, rule.middle):
        marked = marked | F.contains(text, F.lit(m))
    h = [_hash_number(F.col(code), i) for i in range(4)]
    plain = (length == 0) | marked | (h[2] % 100 >= rule.cut_of_100)
    ends = [h[i] % (length + 1) for i in range(2)]
    made = made.withColumn(form, F.when(plain, "plain").when(h[3] % 100 < rule.spm_of_100, "spm").otherwise("psm"))
    made = made.withColumn(first, F.least(*ends)).withColumn(second, F.greatest(*ends)).drop(code)
    whole = F.col(form) != "plain"
    made = made.withColumn(prefix, F.when(whole, F.col(first)))
    made = made.withColumn(middle, F.when(whole, F.col(second) - F.col(first)))
    return made.mapInArrow(_scattered(text_col, first, second, form, marks), _open(made.schema)).drop(first, second)


def restore(made: DataFrame, rule: Rule = Rule(), text_col: str = "text", form_col: str = "form") -> DataFrame:
    """``made`` with every text put back from its fill-in-middle form; other columns stay.

    Null texts become empty, a null form counts as plain. A cut text without each mark once raises.
    """
    return made.mapInArrow(_gathered(text_col, form_col, rule.marks()), _open(made.schema))


def _open(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def digest(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    made = cut_texts(rows, rule).withColumn("output_sha256", F.sha2("text", 256))
    return restore(made, rule).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2("text", 256).alias("restored_sha256")
    )


SQL = """
with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
h as (select *, ('0x' || h[1:8])::bigint % (n + 1) as x, ('0x' || h[9:16])::bigint % (n + 1) as y,
             ('0x' || h[17:24])::bigint % 100 as u, ('0x' || h[25:32])::bigint % 100 as v from d),
f as (select doc_id, t, n, least(x, y) as p, greatest(x, y) as q,
             case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or u >= 90 then 'plain'
                  when v < 20 then 'spm' else 'psm' end as form from h),
o as (select *, substring(t, 1, p) as a, substring(t, p + 1, q - p) as b, substring(t, q + 1) as c from f)
select doc_id, n::bigint as n, form, case when form <> 'plain' then p end::bigint as prefix_chars,
       case when form <> 'plain' then q - p end::bigint as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || a || '<S>' || c || '<M>' || b
                        else '<S>' || c || '<P>' || a || '<M>' || b end) as output_sha256,
       sha256(t) as restored_sha256 from o
"""


@query("op12_fill_middle", SQL)
def op12_fill_middle(spark, sf):
    return digest(table(spark, sf, "documents"))
