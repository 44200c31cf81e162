"""Hierarchical multi-length packing (operator 2).

Documents become token ids plus an end id.  Whole windows of the longest tier
leave a long document first; what is left of each document (shorter than one
window) is routed to the smallest context-size tier that holds it.  Tiers are
packed from the longest to the shortest: the longest piece opens a sequence,
its gap takes the longest shorter pieces that fit whole, and the last gap is
closed by cutting one more piece, so every sequence but the last of a packing
group is exactly as long as its tier.  Sequences of one tier that together fill
a window form a slot; slots are dealt to step groups in snake order of tier and
attention cost, so that all steps hold the same tokens and nearly the same mix.

Packing groups hold about ``group_bytes`` of text each, dealt by row position
and not by any key, so no hot id, source or copy can overfill one; a group is
packed in one task from pieces of less than a window each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import id_and_text, tidy
from homeledger.llm.tokens import word_ids

TIERS = (256, 512, 1024, 2048)
END_ID = 1
GROUP_BYTES = 4 << 20
ROW_BYTES = 32  # what a row counts besides its text: it gives an end id and a piece
STEP_SLOTS = 32


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS):
    """Sequences of (item, start, length) pieces over items shorter than the longest tier.

    Returns ``[(tier, pieces)]``; ``tier`` is 0 for a last sequence shorter
    than every tier.  Equal lengths are taken in the order of the items.
    """
    by_len: dict[int, list[tuple[int, int]]] = {}
    mask = 0
    for i in sorted(range(len(lengths)), reverse=True):
        if lengths[i] > 0:
            by_len.setdefault(lengths[i], []).append((i, 0))
            mask |= 1 << lengths[i]

    def take(n: int) -> tuple[int, int]:
        nonlocal mask
        held = by_len[n]
        item = held.pop()
        if not held:
            mask &= ~(1 << n)
        return item

    def put(n: int, item: tuple[int, int]) -> None:
        nonlocal mask
        by_len.setdefault(n, []).append(item)
        mask |= 1 << n

    out = []
    sizes = sorted(tiers, reverse=True)
    for tier, below in zip(sizes, [*sizes[1:], 0]):
        while (mask & ((1 << (tier + 1)) - 1)) >> (below + 1):
            pieces, gap = [], tier
            while gap and mask:
                fits = mask & ((1 << (gap + 1)) - 1)
                if fits:
                    n = fits.bit_length() - 1
                    item, start = take(n)
                    cut = n
                else:  # every piece left is longer than the gap: cut the shortest
                    n = (mask & -mask).bit_length() - 1
                    item, start = take(n)
                    cut = gap
                    put(n - cut, (item, start + cut))
                pieces.append((item, start, cut))
                gap -= cut
            out.append((tier if gap == 0 else 0, pieces))
    return out


def step_groups(seqs: list[tuple[int, int]], window: int, slots_a_step: int) -> list[int]:
    """Step group of each (tier, cost) sequence; see the module text."""
    order = sorted(range(len(seqs)), key=lambda k: (-(seqs[k][0] or window), -seqs[k][1], k))
    slots, room, last = [], 0, None
    for k in order:
        tier = seqs[k][0] or window
        if tier != last or room < tier:
            slots.append([])
            room, last = window, tier
        slots[-1].append(k)
        room -= tier
    steps = max(1, -(-len(slots) // slots_a_step))
    group = [0] * len(seqs)
    for j, slot in enumerate(slots):
        turn, at = divmod(j, steps)
        for k in slot:
            group[k] = at if turn % 2 == 0 else steps - 1 - at
    return group


def token_rows(docs: DataFrame, tokenizer: str, window: int, groups: int, with_ids: bool = False) -> DataFrame:
    """Pieces of documents: whole windows (crc only, unless ``with_ids``) and the rest of each document with its ids."""
    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        tok = word_ids(tokenizer)
        end = END_ID.to_bytes(tok.size, "little")
        part, seen = TaskContext.get().partitionId(), 0
        crc = lambda b: zlib.crc32(np.frombuffer(b, tok.dtype).astype("<u4").tobytes())
        step = window * tok.size

        def flush(ids_of, out):
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), ids_of.take(pa.array(cols[1])), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()),
                 pa.array(cols[6], pa.binary())],
                names=["grp", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

        for b in batches:
            out, held = [], 0
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = tok.text_ids(text) + end
                n = len(ids) // tok.size
                # rows are spread by their place in the scan: an odd multiplier deals neighbours apart
                grp = (part * 1_000_003 + seen) * 2_654_435_761 % (1 << 32) * groups >> 32
                seen += 1
                whole = n // window
                for k in range(whole):
                    cut = ids[k * step:(k + 1) * step]
                    out.append((grp, i, k * window, window, n, crc(cut), cut if with_ids else None))
                if n % window:
                    out.append((grp, i, whole * window, n % window, n, None, ids[whole * step:]))
                held += len(ids)
                if held > 8 << 20:
                    yield flush(b.column(0), out)
                    out, held = [], 0
            if out:
                yield flush(b.column(0), out)
        tidy(keep="word_ids")

    schema = f"grp int, doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, group_bytes: int = GROUP_BYTES,
         slots_a_step: int = STEP_SLOTS, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier,
    step_group`` (and ``ids``, little-endian, with ``with_ids``).  ``tier`` is
    the length of the piece's sequence, 0 for the one sequence per packing
    group that may need padding.

    A null or empty text is the end id alone.  Null ids and repeated rows are
    packed like others, each row for itself; an empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    tiers = tuple(sorted(tiers))
    window = tiers[-1]
    rows = id_and_text(docs)
    total = rows.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    groups = max(1, -(-int(total) // group_bytes))
    pieces = token_rows(docs, tokenizer, window, groups, with_ids)
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(table):
        import zlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        grp = table.column("grp")[0].as_py()
        # an order that does not depend on how the shuffle delivered the rows
        table = table.append_column("k", pc.fill_null(table.column("ids"), b"")).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("k", "ascending")])
        length = table.column("length").to_pylist()
        start = table.column("start").to_pylist()
        known = table.column("ids_crc32").to_pylist()
        ids = table.column("ids").to_pylist()
        rest = [i for i in range(len(length)) if known[i] is None]
        width = len(ids[rest[0]]) // length[rest[0]] if rest else 2
        dtype = f"<u{width}"
        seqs = [(window, [(i, 0, window)]) for i in range(len(length)) if known[i] is not None]
        seqs += [(t, [(rest[i], s, n) for i, s, n in pieces])
                 for t, pieces in pack_lengths([length[i] for i in rest], tiers)]
        step = step_groups([(t, sum(n * n for _, _, n in p)) for t, p in seqs], window, slots_a_step)
        row, at, n_ids, crc, seq, off, tier, group, raw = [], [], [], [], [], [], [], [], []
        for k, (t, pieces) in enumerate(seqs):
            o = 0
            for i, s, n in pieces:
                if known[i] is not None:
                    crc.append(known[i])
                    raw.append(ids[i])
                else:
                    cut = ids[i][s * width:(s + n) * width]
                    crc.append(zlib.crc32(np.frombuffer(cut, dtype).astype("<u4").tobytes()))
                    raw.append(cut)
                row.append(i)
                at.append(start[i] + s)
                n_ids.append(n)
                seq.append(grp << 32 | k)
                off.append(o)
                tier.append(t)
                group.append(grp << 32 | step[k])
                o += n
        pick = pa.array(row, pa.int64())
        long = lambda x: pa.array(x, pa.int64())
        cols = [table.column("doc_id").take(pick), long(at), long(n_ids), long(crc),
                table.column("doc_tokens").take(pick), long(seq), long(off), pa.array(tier, pa.int32()), long(group)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier",
                 "step_group"]
        if with_ids:
            cols.append(pa.array(raw, pa.binary()))
            names.append("ids")
        return pa.Table.from_arrays(cols, names=names)

    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, tier int, step_group long") + (", ids binary" if with_ids else "")
    return pieces.groupBy("grp").applyInArrow(run, schema)
