"""Suffix-array dedup: bytes covered by long strings that occur elsewhere, by longest-previous-factor arrays.

A string of ``match`` bytes is looked for at every byte of every text. Comparing all suffixes
of a corpus at once would move many times its size, so suffixes are brought together first:

1. The smallest of the gram codes inside a string is its anchor (leftmost if several). Equal
   strings have equal anchors at the same place, and neighbouring strings mostly share one. Each
   anchor is one row: its gram, the strings it stands for, and a code of all their bytes (context).
2. Anchors are shuffled once, by gram, and read as a stream. A gram with one anchor has no match.
   All members of a context that occurs again lose their strings (but the first, for
   ``keep="first"``) without another look at them. Only grams with different contexts go on.
3. Bytes of these contexts, one member each, go to buckets by gram. There the strings are put
   into suffix order; previous and next smaller positions in that order give the longest previous
   factor of each (and the longest later one, with positions reversed). Lengths are exact up to
   ``match``, which is all that is asked.
4. Each text takes the union of its removed strings.

Grams that are frequent in a sample of texts are dealt over many tasks in step 2, and their
contexts counted by partial sums; the sample decides on the way only, never on results. A gram
with more than ``CROWDED`` different contexts (a passage in very many texts, with other text
around it in each) isn't put into suffix order: its strings are counted by 64-bit codes, in blocks
first. A block whose bytes agree with another's is decided as a whole, and so is one whose common
bytes occur once; the rest is divided into single strings.

``keep="first"`` removes later copies and keeps the first (by id, then position);
``keep="none"`` removes every copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .common import join_groups, query, release, row_code, table, texts
from .shingles import _BYTE, _power, mix, slices

MATCH = 200
GRAM = 40
CONTEXTS_PER_BUCKET = 2_000
STRINGS_AT_ONCE = 100_000
CROWDED = 5_000  # different contexts of a gram (300 bytes each) beyond which they are divided
BROADCAST_ROWS = 1_000_000  # row codes (8 bytes) that may be broadcast
SAMPLE_ROWS = 10_000  # texts in which frequent grams are looked for
HOT_IN_SAMPLE = 10  # anchors there that make a gram frequent, or a thousandth of the sampled texts
HOT_GRAMS = 50_000  # frequent grams at most, the most frequent first
SPREAD = 64  # parts of a frequent gram
BLOCK = 13  # strings that are looked at together in the contexts of a crowded gram

# --- arrays ----------------------------------------------------------------------------------


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place, the nearest place before it with a smaller value, or -1; by pointer jumping."""
    found = np.arange(-1, len(values) - 1)
    active = np.flatnonzero(found >= 0)
    while len(active):
        active = active[values[found[active]] >= values[active]]
        found[active] = found[found[active]]
        active = active[found[active] >= 0]
    return found


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes in which rows of two matrices agree from the start."""
    differ = a != b
    first = differ.argmax(axis=1)
    return np.where(differ.any(axis=1), first, a.shape[1])


def longest_previous_factor(strings: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Longest common prefix (up to the strings' width) of each string with one at a smaller position.

    ``strings`` holds one string per row. In suffix order, the best match among smaller positions
    is the previous or the next smaller one.
    """
    if not len(strings):
        return np.empty(0, np.int64)
    width = strings.shape[1]
    order = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    place = position[order]
    before = previous_smaller(place)
    after = len(order) - 1 - previous_smaller(place[::-1])[::-1]
    sorted_strings = strings[order]
    best = np.zeros(len(order), np.int64)
    for near, there in ((before, before >= 0), (after, after < len(order))):
        at = np.flatnonzero(there)
        best[at] = np.maximum(best[at], common_prefix(sorted_strings[at], sorted_strings[near[at]]))
    out = np.empty_like(best)
    out[order] = best
    return out


def gram_codes(data: np.ndarray) -> np.ndarray:
    """Codes of all runs of ``GRAM`` = 32 + 8 bytes."""
    step = 0x9E3779B97F4A7C15
    h, width, eight = _BYTE[data], 1, None
    while width < 32:
        if width == 8:
            eight = h
        h = h[:-width] * np.uint64(step) + h[width:]
        step = (step * step + 2) % 2**64
        width *= 2
    m = len(data) - GRAM + 1
    return mix(h[:m] * np.uint64(step) + eight[32:32 + m])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, edges: np.ndarray, match: int) -> dict[str, np.ndarray]:
    """Anchor rows of concatenated texts; ``edges`` are the bytes where texts begin, and the end.

    gram, context, text (index), pos (of the anchor in its text), before (bytes from the first
    string's begin to the anchor), strings (number).
    """
    none = {k: np.empty(0, np.int64) for k in ("gram", "context", "text", "pos", "before", "strings")}
    window = match - GRAM + 1
    if len(data) < match:
        return none
    codes = gram_codes(data)
    least = sliding_min(codes, window)
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[:len(least)]
    valid = np.arange(len(least)) + match <= edges[text + 1]
    same = np.zeros(len(least), bool)
    same[1:] = valid[1:] & valid[:-1] & (least[1:] == least[:-1]) & (codes[:len(least) - 1] != least[:-1])
    first = np.flatnonzero(valid & ~same)
    if not len(first):
        return none
    ends = np.flatnonzero(valid & ~np.append(same[1:], False))  # the last string of each run
    anchor = np.empty(len(first), np.int64)
    for a in range(0, len(first), 20_000):
        part = first[a:a + 20_000]
        anchor[a:a + 20_000] = part + np.lib.stride_tricks.sliding_window_view(codes, window)[part].argmin(axis=1)
    up, down = _power(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)))
    past = ends + match
    before = anchor - first
    context = mix((total[past] - total[first]) * down[first] + (past - first).astype(np.uint64) * np.uint64(1009) + before.astype(np.uint64))
    gram = codes[anchor]
    owner = text[first]
    return {"gram": gram.view(np.int64), "context": context.view(np.int64), "text": owner, "pos": anchor - edges[owner],
            "before": before, "strings": ends - first + 1}


def string_codes(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    up, down = _power(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)))
    return mix((total[starts + width] - total[starts]) * down[starts])


def bucket_verdicts(contexts: list[tuple[int, int, bytes]], match: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per context (order, begin, bytes): whether each of its strings has an equal one at an earlier
    place, and whether it has one at a later place, both for the first copy of the context.

    ``order`` and ``begin`` give the place of the first copy. Strings whose code is single in the
    bucket have no match in it; the others are compared in suffix order.
    """
    counts = np.array([len(b) - match + 1 for *_, b in contexts], np.int64)
    data = np.frombuffer(b"".join([b for *_, b in contexts]), np.uint8)
    offset = np.cumsum([0] + [len(b) for *_, b in contexts])[:-1]
    own = np.repeat(np.arange(len(contexts)), counts)
    inside = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offset[own] + inside
    code = string_codes(data, start, match)
    order = np.argsort(code, kind="stable")
    sorted_code = code[order]
    equal = sorted_code[1:] == sorted_code[:-1]
    shared = np.zeros(len(code), bool)
    shared[order[1:][equal]] = True
    shared[order[:-1][equal]] = True
    # Place of each string: by order of the text, then its byte. Numbered densely for comparison.
    which = order[shared[order]]  # by code, so equal strings stay in one part
    doc = np.array([o for o, *_ in contexts], np.int64)
    begin = np.array([b for _, b, _ in contexts], np.int64)
    earlier, later = np.zeros(len(code), bool), np.zeros(len(code), bool)
    span = np.lib.stride_tricks.sliding_window_view(data, match) if len(data) >= match else None
    a = 0
    while a < len(which):
        b = min(len(which), a + STRINGS_AT_ONCE)
        while b < len(which) and code[which[b]] == code[which[b - 1]]:
            b += 1
        part = which[a:b]
        place = np.empty(len(part), np.int64)
        place[np.lexsort((begin[own[part]] + inside[part], doc[own[part]]))] = np.arange(len(part))
        strings = span[start[part]]
        earlier[part] = longest_previous_factor(strings, place) >= match
        later[part] = longest_previous_factor(strings, -place) >= match
        a = b
    cuts = np.cumsum(counts)[:-1]
    return list(zip(np.split(earlier, cuts), np.split(later, cuts)))


# --- tasks -----------------------------------------------------------------------------------


def _packed(pos: np.ndarray, before: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """An anchor's place, the bytes before it and its strings as one number in order of the place."""
    return (pos.astype(np.int64) << 32) | (before.astype(np.int64) << 16) | strings.astype(np.int64)


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin of the first string, strings)."""
    return (at >> 32) - ((at >> 16) & 0xFFFF), at & 0xFFFF


def _begin_of(at: str):
    return (F.shiftright(at, 32) - F.shiftright(at, 16).bitwiseAND(F.lit(0xFFFF))).alias("begin")


def _strings_of(at: str):
    return F.col(at).bitwiseAND(F.lit(0xFFFF)).alias("strings")


_ANCHOR = "gram long, part int, context long, row long, place {place}, at long"


def _anchor_rows(match: int, hot: np.ndarray):
    """Anchor rows; ``part`` is -1, or one of ``SPREAD`` parts for the grams in ``hot`` (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                data = [(t or "").encode() for t in batch.column("text").to_pylist()]
                edges = np.cumsum([0] + [len(d) for d in data])
                out = anchors(np.frombuffer(b"".join(data), np.uint8), edges, match)
                text = pa.array(out["text"])
                row = batch.column("row").take(text)
                part = np.full(len(text), -1, np.int32)
                if len(hot) and len(text):
                    near = np.minimum(np.searchsorted(hot, out["gram"]), len(hot) - 1)
                    is_hot = hot[near] == out["gram"]
                    part[is_hot] = (mix(row.to_numpy().view(np.uint64)[is_hot]) % np.uint64(SPREAD)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "gram": pa.array(out["gram"], pa.int64()), "part": pa.array(part), "context": pa.array(out["context"], pa.int64()),
                    "row": row, "place": batch.column("place").take(text),
                    "at": pa.array(_packed(out["pos"], out["before"], out["strings"])),
                })

    return run


HIT, CONTEXT, MEMBER = 0, 1, 2
_GROUPED = "kind byte, gram long, context long, row long, place {place}, at long, copies long"


def _grouped(keep: str):
    """From anchors in order of (gram, part, context, place, at): ``HIT`` rows, all of whose strings go,
    first members of the contexts of grams with several (``CONTEXT``), and frequent grams' rows as they are (``MEMBER``)."""

    def rows(t: pa.Table, index: np.ndarray, kind: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
        t = t.take(pa.array(index))
        return pa.RecordBatch.from_pydict(
            {"kind": pa.array(kind.astype(np.int8))}
            | {c: t.column(c).combine_chunks() for c in ("gram", "context", "row", "place", "at")}
            | {"copies": pa.array(copies.astype(np.int64))}
        )

    def judged(t: pa.Table) -> pa.RecordBatch:
        gram, context = t.column("gram").to_numpy(), t.column("context").to_numpy()
        new_gram = np.concatenate(([True], gram[1:] != gram[:-1]))
        first = np.flatnonzero(new_gram | np.concatenate(([True], context[1:] != context[:-1])))
        copies = np.diff(np.append(first, len(gram)))
        of_gram = (np.cumsum(new_gram) - 1)[first]
        several = np.bincount(of_gram)[of_gram] > 1
        hit = np.repeat(copies > 1, copies)
        if keep == "first":  # rows with equal id and text share the first place
            row, at, lead = t.column("row").to_numpy(), t.column("at").to_numpy(), np.repeat(first, copies)
            hit &= (row != row[lead]) | (at != at[lead])
        hits = np.flatnonzero(hit)
        return rows(t, np.concatenate((hits, first[several])),
                    np.concatenate((np.full(len(hits), HIT), np.full(several.sum(), CONTEXT))),
                    np.concatenate((np.zeros(len(hits)), copies[several])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the gram that may go on
        for batch in batches:
            spread = batch.column("part").to_numpy() >= 0
            if spread.any():
                of = np.flatnonzero(spread)
                yield rows(pa.Table.from_batches([batch]), of, np.full(len(of), MEMBER), np.ones(len(of)))
                batch = batch.take(pa.array(np.flatnonzero(~spread)))
            if not batch.num_rows:
                continue
            gram = batch.column("gram").to_numpy()
            last = len(gram) - int(np.argmax(gram[::-1] != gram[-1])) if (gram != gram[-1]).any() else 0
            if last or (held and held[-1].column("gram")[0].as_py() != gram[0]):
                whole = pa.Table.from_batches([*held, batch.slice(0, last)])
                if whole.num_rows:
                    yield judged(whole)
                held = []
            held.append(batch.slice(last))
        if held:
            yield judged(pa.Table.from_batches(held))

    return run


_BYTES = "gram long, context long, row long, place {place}, begin long, before long, copies long, many boolean, bytes binary"


def _context_bytes(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                asked = batch.column("asked")
                flat = asked.flatten()
                at = flat.field("at").to_numpy()
                begin, strings = _unpacked(at)
                counts = pa.compute.list_value_length(asked).to_numpy()
                data, of = [t.encode() for t in batch.column("text").to_pylist()], np.repeat(np.arange(len(counts)), counts)
                pieces = [data[o][b:b + n + match - 1] for o, b, n in zip(of.tolist(), begin.tolist(), strings.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "gram": flat.field("gram"), "context": flat.field("context"), "row": batch.column("row").take(pa.array(of)),
                    "place": flat.field("place"), "begin": pa.array(begin), "before": pa.array((at >> 16) & 0xFFFF),
                    "copies": flat.field("copies"), "many": flat.field("many"), "bytes": pa.array(pieces, pa.binary()),
                })

    return run


def span_codes(data: np.ndarray, start: np.ndarray, past: np.ndarray) -> np.ndarray:
    """Codes of the bytes from ``start`` to ``past``, of any lengths."""
    up, down = _power(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)))
    return mix((total[past] - total[start]) * down[start] + (past - start).astype(np.uint64) * np.uint64(1009))


_UNIT = "gram long, row long, place {place}, own long, begin long, strings long, core long, whole long"


def _units(match: int):
    """The strings of each context in blocks by their distance to the anchor, at most ``BLOCK`` each.

    ``core`` is a code of the bytes that all strings of the whole block have in common, and
    ``whole`` one of all bytes of those that are here; both tell blocks apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for batch in slices(given, "bytes", 1_000_000):
                each = batch.column("bytes").to_pylist()
                size = np.array([len(x) for x in each], np.int64)
                offset, n = np.cumsum(size) - size, size - match + 1
                before = batch.column("before").to_numpy()
                own = np.repeat(np.arange(len(n)), n)
                inside = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                block = (before[own] - inside) // BLOCK
                first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (block[1:] != block[:-1]))))
                strings = np.diff(np.append(first, len(own)))
                own, inside, block = own[first], inside[first], block[first]
                data, start, anchor = np.frombuffer(b"".join(each), np.uint8), offset[own] + inside, offset[own] + before[own]
                near, far = block * BLOCK, np.minimum(block * BLOCK + BLOCK - 1, match - GRAM)
                core = span_codes(data, anchor - near, anchor + match - far)
                whole = span_codes(data, start, start + strings + match - 1)
                of = pa.array(own)
                yield pa.RecordBatch.from_pydict({c: batch.column(c).take(of) for c in ("gram", "row", "place")} | {
                    "own": batch.column("begin").take(of), "begin": pa.array(batch.column("begin").to_numpy()[own] + inside),
                    "strings": pa.array(strings), "core": pa.array(mix(core + block.astype(np.uint64)).view(np.int64)),
                    "whole": pa.array(mix(whole + (before[own] - inside).astype(np.uint64)).view(np.int64)),
                })

    return run


def _single_strings(match: int):
    """The strings of the asked blocks with codes of their bytes and their distance to the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each, asked = batch.column("bytes").to_pylist(), batch.column("asked")
            size = np.array([len(x) for x in each], np.int64)
            counts = pa.compute.list_value_length(asked).to_numpy()
            blocks, context = asked.flatten(), np.repeat(np.arange(len(counts)), counts)
            n = blocks.field("strings").to_numpy()
            of = np.repeat(np.arange(len(n)), n)
            begin = blocks.field("begin").to_numpy()[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            own = context[of]
            inside = begin - batch.column("begin").to_numpy()[own]
            code = span_codes(np.frombuffer(b"".join(each), np.uint8), (start := (np.cumsum(size) - size)[own] + inside), start + match)
            code = mix(code + (batch.column("before").to_numpy()[own] - inside).astype(np.uint64))
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(pa.array(own)) for c in ("gram", "row", "place")} | {
                "begin": pa.array(begin), "code": pa.array(code.view(np.int64)),
            })

    return run


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of each run of true values."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    begin = np.flatnonzero(edge == 1)
    return begin, np.flatnonzero(edge == -1) - begin


_HIT = "row long, begin long, strings long"


def _judge_bucket(match: int, keep: str):
    """Runs of removed strings of the contexts of a bucket. With ``keep="none"``, members of a context that occurs again are hits already."""

    def run(t: pa.Table) -> pa.Table:
        columns = {c: t.column(c).to_pylist() for c in t.column_names}
        # Twice only if rows with equal id and text exist.
        once = list({key: i for i, key in enumerate(zip(columns["gram"], columns["context"]))}.values())
        place = columns["place"]
        known = sorted({place[i] for i in once if place[i] is not None})
        order = {p: k for k, p in enumerate(known)} | {None: len(known)}
        once.sort(key=lambda i: columns["gram"][i])
        out: list[tuple[int, int, int]] = []
        at = 0
        while at < len(once):  # strings of different grams never match
            past, strings = at, 0
            while past < len(once) and (strings < STRINGS_AT_ONCE or columns["gram"][once[past]] == columns["gram"][once[past - 1]]):
                strings += len(columns["bytes"][once[past]]) - match + 1
                past += 1
            part = once[at:past]
            verdicts = bucket_verdicts([(order[place[i]], columns["begin"][i], columns["bytes"][i]) for i in part], match)
            for i, (earlier, later) in zip(part, verdicts):
                if keep == "first" or columns["copies"][i] == 1:
                    begin, n = runs(earlier if keep == "first" else earlier | later)
                    out += zip([columns["row"][i]] * len(n), (begin + columns["begin"][i]).tolist(), n.tolist())
            at = past
        row, begin, n = zip(*out) if out else ((), (), ())
        return pa.table({"row": pa.array(row, pa.int64()), "begin": pa.array(begin, pa.int64()), "strings": pa.array(n, pa.int64())})

    return run


def removed_bytes(edges: np.ndarray, owner: np.ndarray, begin: np.ndarray, strings: np.ndarray, match: int) -> np.ndarray:
    """Which bytes of concatenated texts are covered by removed strings.

    Of the text ``owner[k]`` go ``strings[k]`` strings, which begin at its byte ``begin[k]`` and after.
    """
    delta = np.zeros(edges[-1] + 1, np.int32)
    start = edges[owner] + begin
    np.add.at(delta, start, 1)
    np.add.at(delta, start + strings + match - 1, -1)
    return np.cumsum(delta[:-1], dtype=np.int32) > 0


def _cut_rows(match: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text", 1_000_000):
                texts_, hits = batch.column("_text").to_pylist(), batch.column("_hits")
                each = [(t or "").encode() for t in texts_]
                edges = np.cumsum([0] + [len(d) for d in each])
                flat = hits.flatten()
                counts = pa.compute.fill_null(pa.compute.list_value_length(hits), 0).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(each)), counts)
                gone = removed_bytes(edges, owner, flat.field("begin").to_numpy(zero_copy_only=False), flat.field("strings").to_numpy(zero_copy_only=False), match)
                for i in np.flatnonzero(batch.column("_copy").to_numpy() > 1):  # an equal row came before
                    if len(each[i]) >= match:
                        gone[edges[i]:edges[i + 1]] = True
                first = gone.copy()
                first[1:] &= ~gone[:-1]
                at_edge = edges[:-1][edges[:-1] < edges[1:]]
                first[at_edge] = gone[at_edge]
                n_removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[edges])
                n_spans = np.diff(np.concatenate(([0], np.cumsum(first)))[edges])
                left = np.frombuffer(b"".join(each), np.uint8)[~gone].tobytes()
                kept_edges = np.concatenate(([0], np.cumsum(np.diff(edges) - n_removed)))
                kept = []
                for i, (a, b) in enumerate(zip(kept_edges[:-1], kept_edges[1:])):
                    if not with_text:
                        kept.append(hashlib.sha256(left[a:b]).hexdigest())
                    elif n_removed[i]:
                        kept.append(left[a:b].decode("utf-8", "ignore"))
                    else:
                        kept.append(texts_[i])
                made = {c: batch.column(c) for c in batch.schema.names if c not in ("_text", "_hits", "_copy")}
                yield pa.RecordBatch.from_pydict(made | {
                    "_n_bytes": pa.array(np.diff(edges), pa.int64()), "_n_removed": pa.array(n_removed, pa.int64()),
                    "_n_spans": pa.array(n_spans, pa.int64()), "_kept": pa.array(kept, pa.string()),
                })

    return run


# --- operator --------------------------------------------------------------------------------


def _frequent_grams(rows: DataFrame, match: int, schema: str) -> np.ndarray:
    """Grams of many anchors in about ``SAMPLE_ROWS`` texts, at most ``HOT_GRAMS`` (8 bytes each), sorted."""
    share = min(1.0, SAMPLE_ROWS / max(1, rows.count()))
    drawn = rows.filter(F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1_000_003)) < int(1_000_003 * share) + 1)
    counts = drawn.mapInArrow(_anchor_rows(match, np.empty(0, np.int64)), schema).groupBy("gram").agg(F.count("*").alias("n"))
    least = max(HOT_IN_SAMPLE, SAMPLE_ROWS // 1000)
    found = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "gram").limit(HOT_GRAMS).select("gram").collect()
    return np.sort(np.array([r.gram for r in found], np.int64))


def _hits_of_frequent(members: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
    """Hits of the frequent grams' rows in contexts that occur again, and the contexts of grams with several, or ``many``."""
    order = F.struct(F.col("place").isNull(), "place", "at")
    contexts = cut(
        members.groupBy("gram", "context").agg(F.count("*").alias("copies"), F.min_by(F.struct("row", "place", "at"), order).alias("head")),
        "contexts",
    )
    again = contexts.filter("copies > 1").select("gram", "context", "copies", "head")
    rows = join_groups(members.drop("copies"), again, ["gram", "context"], "copies")
    if keep == "first":
        rows = rows.filter((F.col("row") != F.col("head.row")) | (F.col("at") != F.col("head.at")))
    sizes = F.broadcast(contexts.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"))  # HOT_GRAMS rows at most
    several = contexts.join(sizes, "gram")
    return rows.select("row", "at"), several.select(
        "gram", "context", "head.row", "head.place", "head.at", "copies", (F.col("n") > CROWDED).alias("many")
    )


def repeated_strings(docs: DataFrame, match: int = MATCH, keep: str = "none", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, hits): per row code the strings to remove, as runs (begin, strings)."""
    if not GRAM < match < 2**15 or keep not in ("none", "first"):
        raise ValueError(f"match must be above {GRAM} and below 32768, and keep one of 'none' and 'first'")
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("row", row_code())
    place = F.col("doc_id") if keep == "first" else F.lit(None).cast("int")
    rows = rows.select("text", "row", place.alias("place"))
    kind = rows.schema["place"].dataType.simpleString()
    named = lambda schema: schema.format(place=kind)
    hot = _frequent_grams(rows, match, named(_ANCHOR))
    dealt = rows.mapInArrow(_anchor_rows(match, hot), named(_ANCHOR)).repartition("gram", "part")
    dealt = dealt.sortWithinPartitions("gram", "part", "context", F.asc_nulls_last("place"), "at")
    grouped = cut(dealt.mapInArrow(_grouped(keep), named(_GROUPED)), "grouped")
    release(spark)
    hits = grouped.filter(F.col("kind") == HIT).select("row", "at")
    contexts = grouped.filter(F.col("kind") == CONTEXT).drop("kind").withColumn("many", F.lit(False))
    if len(hot):
        members = grouped.filter(F.col("kind") == MEMBER).drop("kind")
        more, several = _hits_of_frequent(members, keep)
        hits, contexts = hits.unionByName(more), contexts.unionByName(several)
    hits = hits.select("row", _begin_of("at"), _strings_of("at"))
    asked = contexts.groupBy("row").agg(F.collect_list(F.struct("gram", "context", "place", "at", "copies", "many")).alias("asked"))
    parts = rows.select("row", "text").join(asked, "row").select("row", "text", "asked")
    parts = cut(parts.mapInArrow(_context_bytes(match), named(_BYTES)), "parts")
    release(spark)
    few, many = parts.filter("not many"), parts.filter("many")
    buckets = max(1, -(-few.count() // CONTEXTS_PER_BUCKET))
    judged = few.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets))).groupBy("bucket").applyInArrow(_judge_bucket(match, keep), _HIT)
    hits = hits.unionByName(judged)
    if not many.isEmpty():
        hits = hits.unionByName(_crowded_hits(many, match, keep, kind))
    hits = cut(hits.groupBy("row").agg(F.collect_list(F.struct("begin", "strings")).alias("hits")), "hits")
    release(spark)
    return hits


def _crowded_hits(contexts: DataFrame, match: int, keep: str, kind: str) -> DataFrame:
    """(row, begin, strings) for first members of contexts of grams with more of them than one task should hold.

    Most blocks are decided by counts: bytes that all its strings share and no other context has
    leave a block without a match, and equal blocks match string by string. What is left, and the
    first of equal blocks as a partner for it, is counted by single strings.
    """
    first = lambda *more: F.min(F.struct(F.col("place").isNull().alias("none"), "place", "begin", "row", *more)).alias("head")
    is_first = (F.col("row") == F.col("head.row")) & (F.col("begin") == F.col("head.begin"))
    units = cut(contexts.mapInArrow(_units(match), _UNIT.format(place=kind)), "units")
    cores = cut(units.groupBy("gram", "core").agg(F.count("*").alias("n")).filter("n > 1"), "cores")
    alike = cut(units.groupBy("gram", "whole").agg(F.count("*").alias("m"), first()).filter("m > 1"), "alike")
    met = join_groups(join_groups(units, cores, ["gram", "core"], "n"), alike, ["gram", "whole"], "m", "left")
    met = cut(met.drop("core", "whole"), "met")
    same = met.filter(F.col("head").isNotNull())
    hits = (same if keep == "none" else same.filter(~is_first)).select("row", "begin", "strings")
    open_ = met.filter(F.col("head").isNull() | (is_first & (F.col("n") > F.col("m"))))
    asked = open_.groupBy("row", "own").agg(F.collect_list(F.struct("begin", "strings")).alias("asked"))
    singles = cut(
        contexts.join(asked.withColumnRenamed("own", "begin"), ["row", "begin"])
        .mapInArrow(_single_strings(match), f"gram long, row long, place {kind}, begin long, code long"),
        "singles",
    )
    heads = cut(singles.groupBy("gram", "code").agg(F.count("*").alias("n"), first()).filter("n > 1"), "heads")
    found = join_groups(singles, heads, ["gram", "code"], "n")
    if keep == "first":
        found = found.filter(~is_first)
    return hits.unionByName(found.select("row", "begin", F.lit(1).cast("long").alias("strings")))


def _cut_out(docs: DataFrame, match: int, keep: str, id_col: str, text_col: str, columns: list[str], with_text: bool) -> DataFrame:
    """``columns`` of each row with its _n_bytes, _n_removed, _n_spans and _kept (text or its SHA-256)."""
    hits = repeated_strings(docs, match, keep, id_col, text_col).select(F.col("row").alias("_hit_row"), F.col("hits").alias("_hits"))
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    rows = docs.select(*own, F.col(f"`{text_col}`").alias("_text"), row_code(id_col, text_col).alias("_row"))
    same = F.col("_row") == F.col("_hit_row")
    listed = hits.select("_hit_row")
    # Rows with equal id and text share a code; all but one of them are later copies of the whole text.
    copies = keep == "first" and not rows.groupBy("_row").count().filter("count > 1").isEmpty()
    if not copies and hits.count() <= BROADCAST_ROWS:
        # Only texts that lose something are shuffled.
        whole = rows.join(F.broadcast(listed), same, "left_anti").withColumn("_hits", F.lit(None).cast(hits.schema["_hits"].dataType))
        rows = rows.join(F.broadcast(listed), same, "left_semi").join(hits, same).drop("_hit_row").unionByName(whole)
    else:
        rows = rows.join(hits, same, "left").drop("_hit_row")
    if copies:
        rows = rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(0))))
    else:
        rows = rows.withColumn("_copy", F.lit(1))
    rows = rows.drop("_row")
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(columns)]
    fields += [T.StructField(c, T.LongType()) for c in ("_n_bytes", "_n_removed", "_n_spans")] + [T.StructField("_kept", T.StringType())]
    return rows.mapInArrow(_cut_rows(match, with_text), T.StructType(fields))


def digest(docs: DataFrame, match: int = MATCH, keep: str = "none", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    * Null texts are empty; texts below ``match`` bytes keep everything.
    * Strings overlap freely, within a text too, and never reach over two texts.
    * Rows with equal id and text are copies of each other like any others.
    * An empty table gives no rows. Other columns are not read.
    """
    out = _cut_out(docs, match, keep, id_col, text_col, [id_col], False)
    return out.select(
        F.col("c0").alias("doc_id"), F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"), F.col("_kept").alias("kept_sha256"),
    )


def dedup(docs: DataFrame, match: int = MATCH, keep: str = "first", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings cut out of the text; columns and rows stay.

    The first copy is that of the smallest id, whatever its type; a null id comes last. Null texts
    stay null. Bytes of a character that a cut splits are dropped. Rows that share an id but not
    the text keep one copy of what they share; which of them keeps it is not defined.
    """
    columns = docs.columns
    out = _cut_out(docs, match, keep, id_col, text_col, [c for c in columns if c != text_col], True)
    names = {c: f"c{i}" for i, c in enumerate([c for c in columns if c != text_col])} | {text_col: "_kept"}
    return out.select(*[F.col(names[c]).alias(c) for c in columns])


@query("op4_suffix_repeats")
def op4_suffix_repeats(spark, sf):
    return digest(table(spark, sf, "documents"))
