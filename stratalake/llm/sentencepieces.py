"""SentencePiece encoding, decoding and sampling of distinct segmentations.

``encode`` gives the tokenizer's own ids.  Sampling draws ``k`` segmentations *without
replacement* from the lattice of all ways to spell a text with pieces: a piece weighs
``(id + 1) ** -ALPHA`` (ids follow merge rank, so this is Zipf's law), a segmentation the product.
Perturbed A* search over the lattice does it: every set of segmentations that share a beginning
carries the maximum of its members' Gumbel-perturbed log-probabilities, which can be drawn from
the set's total mass alone; the set with the largest value is opened next, so segmentations come
out in falling order of their perturbed value.  The (k+1)-th value gives each sample's inclusion
probability.  Totals are exact (backward sums over the lattice), nothing is pruned.

Pieces never cross a blank followed by text, so the lattice falls into units (blanks and the word
after them); each distinct unit of a batch is spelled out once.  The random numbers depend only on
the row key, the unit and the step.  Characters without a piece are spelled with byte pieces, and
so is U+2581, which the tokenizer itself would turn into a blank: every text comes back exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import U64, mix, numbers, powers, process_cache, ship, slices, text_bytes

ship(__name__)
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, ALPHA = 2, 1.0
SLICE, REMEMBERED = 1 << 18, 600_000  # a slice's lattice takes some hundred times its bytes
BLANK = 0x20


class Vocabulary:
    """The pieces as bytes with a blank for U+2581, in a table-driven trie."""

    def __init__(self, proto: bytes, alpha: float = ALPHA):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        p = self.processor
        size = p.get_piece_size()
        self.spelled = [b""] * size
        self.byte_id = np.zeros(256, np.int32)
        children: list[dict[int, int]] = [{}]
        piece = [-1]
        for i in range(size):
            if p.is_byte(i):
                b = int(p.id_to_piece(i)[1:-1], 16)
                self.byte_id[b] = i
                self.spelled[i] = bytes([b])
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self.spelled[i] = p.id_to_piece(i).replace("▁", " ").encode()
                at = 0
                for b in self.spelled[i]:
                    if b not in children[at]:
                        children[at][b] = len(children)
                        children.append({})
                        piece.append(-1)
                    at = children[at][b]
                piece[at] = i
        self.trie = np.zeros(len(children) * 256, np.int32)
        for s, edges in enumerate(children):
            for b, t in edges.items():
                self.trie[s * 256 + b] = t
        self.piece = np.array(piece, np.int32)
        self.weight = -alpha * np.log(np.arange(size) + 1.0)
        self.byte_weight = -alpha * np.log(float(size))
        self.flat = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.length = np.array([len(s) for s in self.spelled], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.known = np.zeros(0, U64)  # hashes of units seen, ordered; their ids, one after another
        self.known_first, self.known_size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known_ids = np.zeros(0, np.int32)

    def _spelled_out(self, unit: bytes) -> list[int]:
        """Ids of a unit with U+2581: spelled with bytes from there on."""
        head, tail = unit.split(b"\xe2\x96\x81", 1)
        ids = self.processor.encode(head[1:].decode()) or self.processor.piece_to_id(["▁"])
        return [*ids, *self.byte_id[np.frombuffer(b"\xe2\x96\x81" + tail, np.uint8)].tolist()]

    def own_ids(self, key: np.ndarray, raw: bytes, cut: np.ndarray):
        """The tokenizer's ids of units (each begins with a blank), given by ordered hashes and
        bytes: first and size of each in ``known_ids``.  Only units not seen before are encoded."""
        at = np.searchsorted(self.known, key)
        at[at == len(self.known)] = 0
        new = np.flatnonzero(self.known[at] != key) if len(self.known) else np.arange(len(key))
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.known_ids = np.zeros(0, U64), np.zeros(0, np.int32)
            self.known_first = self.known_size = np.zeros(0, np.int64)
            new = np.arange(len(key))
        if len(new):
            units = [raw[a:b] for a, b in zip(cut[new].tolist(), cut[new + 1].tolist(), strict=True)]
            ids = self.processor.encode([u[1:].decode() for u in units], num_threads=1)
            for i, u in enumerate(units):
                if len(u) == 1:
                    ids[i] = self.processor.piece_to_id(["▁"])
                elif b"\xe2\x96\x81" in u:
                    ids[i] = self._spelled_out(u)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
            place = np.searchsorted(self.known, key[new])
            self.known_first = np.insert(self.known_first, place, len(self.known_ids) + np.cumsum(size) - size)
            self.known_size = np.insert(self.known_size, place, size)
            self.known = np.insert(self.known, place, key[new])
            self.known_ids = np.concatenate([self.known_ids, flat])
        at = np.searchsorted(self.known, key)
        return self.known_first[at], self.known_size[at]

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes the ids spell, the leading blank included."""
        size = self.length[ids]
        start = np.repeat(self.begin[ids] - (np.cumsum(size) - size), size)
        return self.flat[start + np.arange(len(start))]


def _vocabulary(proto: bytes, alpha: float) -> Vocabulary:
    """Made once per Python worker."""
    kept = process_cache()
    key = f"vocabulary {zlib.crc32(proto)} {alpha}"
    if key not in kept:
        kept[key] = Vocabulary(proto, alpha)
    return kept[key]


class Lattice:
    """All pieces over the bytes of distinct units; edges by node, likeliest first."""

    def __init__(self, v: Vocabulary, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        stop = np.repeat(offsets[1:].astype(np.int32), np.diff(offsets))
        begin = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
        start, at, state = begin, begin, np.zeros(len(begin), np.int32)
        following = np.zeros(n, np.int32)
        following[begin] = np.append(begin[1:], n)
        count, alone = np.zeros(n, np.int32), np.zeros(n, bool)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        while len(start):
            state = v.trie[state * 256 + data[at]]
            live = np.flatnonzero(state)
            start, at, state = start[live], at[live] + 1, state[live]
            piece = v.piece[state]
            hit = np.flatnonzero(piece >= 0)
            s, e = start[hit], at[hit]
            found.append((s, e, piece[hit], count[s]))
            count[s] += 1
            alone[s[e == following[s]]] = True
            live = np.flatnonzero(at < stop[start])
            start, at, state = start[live], at[live], state[live]
        s = begin[~alone[begin]]
        found.append((s, following[s], np.full(len(s), -1, np.int32), count[s]))
        count[s] += 1
        # Edges by node without sorting: every edge knows its number; the longest comes first.
        first = np.concatenate([[0], np.cumsum(count)])
        size = int(first[-1])
        start, end, piece = (np.zeros(size, np.int32) for _ in range(3))
        for s, e, p, number in found:
            place = first[s + 1] - 1 - number
            start[place], end[place], piece[place] = s, e, p
        weight = np.where(piece >= 0, v.weight[piece], (end - start) * v.byte_weight)
        final = end == stop[start]
        # Backward sums, all units together by their distance from the end.
        total = np.zeros(n + 1)
        far = (stop - np.arange(n, dtype=np.int32))[begin]
        order = np.argsort(far, kind="stable")
        nodes = begin[order]
        cuts = np.flatnonzero(np.diff(far[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(nodes)], strict=True):
            p = nodes[a:b]
            e, last = first[p], first[p + 1]
            value = weight[e] + np.where(final[e], 0.0, total[end[e]])
            live = np.flatnonzero(e + 1 < last)
            while len(live):
                e = e + 1
                x = e[live]
                other = weight[x] + np.where(final[x], 0.0, total[end[x]])
                value[live] = np.logaddexp(value[live], other)
                live = live[x + 1 < last[live]]
            total[p] = value
        log_p = np.minimum(weight + np.where(final, 0.0, total[end]) - total[start], 0.0)
        self.start, self.end, self.piece, self.log_p, self.first, self.stop = start, end, piece, log_p, first, stop
        p = np.exp(log_p)
        run = np.cumsum(p)
        self.upto = run - np.repeat(run[first[begin]] - p[first[begin]], count[begin])


def uniforms(base: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on ``base`` and ``step`` alone."""
    return ((mix(base + U64(step * 0xD1342543DE82EF95 % 2**64)) >> U64(11)).astype(float) + 0.5) / 2.0**53


def _uniform(base: int, step: int) -> float:
    """The same for one number."""
    full = (1 << 64) - 1
    x = (base + step * 0xD1342543DE82EF95) & full
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & full
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & full
    x ^= x >> 31
    return ((x >> 11) + 0.5) / 2.0**53


def draw(lat: Lattice, unit: np.ndarray, base: np.ndarray):
    """One segmentation per occurrence of a unit (given by its first byte): edges of all
    occurrences, first edge of each, log-probability of each."""
    occurrence, at = np.arange(len(unit)), unit
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    log_p, count = np.zeros(len(unit)), np.zeros(len(unit), np.int64)
    while len(at):
        u = uniforms(base[occurrence], len(steps))
        edge, last = lat.first[at], lat.first[at + 1] - 1
        wait = np.flatnonzero((u >= lat.upto[edge]) & (edge < last))
        while len(wait):
            edge[wait] += 1
            wait = wait[(u[wait] >= lat.upto[edge[wait]]) & (edge[wait] < last[wait])]
        steps.append((occurrence, edge))
        log_p[occurrence] += lat.log_p[edge]
        count[occurrence] += 1
        more = lat.end[edge] < lat.stop[at]
        occurrence, at = occurrence[more], lat.end[edge][more]
    first = np.concatenate([[0], np.cumsum(count)])
    edges = np.zeros(first[-1], np.int64)
    for t, (occurrence, edge) in enumerate(steps):
        edges[first[occurrence] + t] = edge
    return edges, first, log_p


def draw_other(lat: Lattice, unit: int, known: list[tuple], base: int) -> tuple:
    """A segmentation of one unit that is none of the ``known``, in proportion to probability."""
    step = 1 << 20

    def u() -> float:
        nonlocal step
        step += 1
        return _uniform(base, step)

    def pick(a: int, b: int, skip: int = -1) -> int:
        mass = sum(np.exp(lat.log_p[e]) for e in range(a, b) if e != skip)
        x, last = u() * mass, -1
        for e in range(a, b):
            if e != skip:
                last = e
                x -= np.exp(lat.log_p[e])
                if x < 0:
                    break
        return last

    main = known[0]
    while True:
        # Where it leaves the first known one: step t with the mass of all others from there.
        reach, masses = 0.0, []
        for e in main:
            masses.append(np.exp(reach) * -np.expm1(lat.log_p[e]))
            reach += lat.log_p[e]
        x = u() * sum(masses)
        t = 0
        while t < len(main) - 1 and (x >= masses[t] or masses[t] <= 0):
            x -= masses[t]
            t += 1
        while masses[t] <= 0:
            t -= 1
        at = lat.start[main[t]]
        out = [*main[:t], pick(lat.first[at], lat.first[at + 1], main[t])]
        while lat.end[out[-1]] < lat.stop[unit]:
            at = lat.end[out[-1]]
            out.append(pick(lat.first[at], lat.first[at + 1]))
        if tuple(out) not in known:
            return tuple(out)


def _row_best(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of every row and its place; -inf and -1 for rows without units."""
    rows = len(first) - 1
    best, where = np.full(rows, -np.inf), np.full(rows, -1)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        best[some] = np.maximum.reduceat(value, first[:-1][some])
        row = np.repeat(np.arange(rows), np.diff(first))
        at = np.flatnonzero((value == best[row]) & (value > -np.inf))[::-1]
        where[row[at]] = at
    return best, where


def sample(lat: Lattice, unit: np.ndarray, first: np.ndarray, seed: np.ndarray, k: int):
    """Up to ``k`` distinct segmentations per row without replacement.

    ``unit`` holds the first byte of every unit occurrence, ``first`` the first occurrence of
    each row.  Returns per sample (edges, first edge of each occurrence, has, log_p, perturbed
    value), and the (k+1)-th perturbed value of every row.
    """
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    nth = np.arange(len(row)) - first[:-1][row]
    base = mix(seed[row] + nth.astype(U64) * U64(0x9E3779B97F4A7C15))

    def deviations(log_p, value, from_unit, salt):
        """Perturbed value of "same up to here, other from here" for every occurrence."""
        ahead = np.cumsum(log_p) - log_p
        ahead -= ahead[first[:-1][row]] if len(row) else 0
        with np.errstate(divide="ignore"):
            mass = ahead + np.log(-np.expm1(np.minimum(log_p, 0.0)))
        noise = np.log(-np.log(uniforms(base, (1 << 24) + salt)))
        out = -np.logaddexp(-value[row], noise - mass)
        out[(nth < from_unit[row]) | (mass == -np.inf)] = -np.inf
        return out

    edges, cut, log_p = draw(lat, unit, base)
    value = -np.log(-np.log(uniforms(mix(seed), 1 << 23)))
    has = np.diff(first) > 0
    total = np.bincount(row, log_p, rows)
    paths = [(edges, cut, has, total, value)]
    logs, open_sets = [log_p], [deviations(log_p, value, np.zeros(rows, np.int64), 0)]
    taken: dict[tuple[int, int], list[tuple]] = {}
    while True:
        bests = [_row_best(o, first) for o in open_sets]
        parent = np.argmax([b for b, _ in bests], 0)
        value = np.max([b for b, _ in bests], 0)
        if len(paths) == k:
            return paths, value
        r, salt = len(paths), len(paths)
        has = value > -np.inf
        where = np.array([w for _, w in bests])[parent, np.arange(rows)]
        begin = np.where(has, nth[where], 0)
        fresh = np.flatnonzero(has[row] & (nth > begin[row]))
        drawn, drawn_cut, drawn_log = draw(lat, unit[fresh], mix(base[fresh] + U64(salt * 0xA0761D6478BD642F % 2**64)))
        log_p = np.zeros(len(row))
        for p in range(r):
            own = (parent[row] == p) & has[row] & (nth < begin[row])
            log_p[own] = logs[p][own]
        log_p[fresh] = drawn_log
        count = np.zeros(len(row), np.int64)
        for p in range(r):
            own = np.flatnonzero((parent[row] == p) & has[row] & (nth < begin[row]))
            count[own] = np.diff(paths[p][1])[own]
        count[fresh] = np.diff(drawn_cut)
        swapped: dict[int, tuple] = {}
        for i in np.flatnonzero(has):
            p, o = int(parent[i]), int(where[i])
            known = taken.get((p, o))
            if known is None:
                known = taken[(p, o)] = [tuple(paths[p][0][paths[p][1][o] : paths[p][1][o + 1]].tolist())]
            other = draw_other(lat, int(unit[o]), known, int(mix(base[o : o + 1] + U64(salt))[0]))
            known.append(other)
            swapped[o] = other
            log_p[o] = sum(lat.log_p[e] for e in other)
            count[o] = len(other)
            # What is left of the opened set, below the value it was opened at.
            mass = sum(np.exp(sum(lat.log_p[e] for e in s)) for s in known)
            ahead = logs[p][first[i] : o].sum()
            left = -np.inf
            if mass < 1 - 1e-12:
                noise = np.log(-np.log(_uniform(int(base[o]), (1 << 25) + salt)))
                left = -np.logaddexp(-value[i], noise - (ahead + np.log1p(-mass)))
            open_sets[p][o] = left
        cut = np.concatenate([[0], np.cumsum(count)])
        edges = np.zeros(cut[-1], np.int64)
        for p in range(r):
            own = np.flatnonzero((parent[row] == p) & has[row] & (nth < begin[row]))
            size = count[own]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            edges[np.repeat(cut[own], size) + place] = paths[p][0][np.repeat(paths[p][1][own], size) + place]
        size = count[fresh]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        edges[np.repeat(cut[fresh], size) + place] = drawn
        for o, other in swapped.items():
            edges[cut[o] : cut[o + 1]] = other
        paths.append((edges, cut, has, np.bincount(row, log_p, rows), value))
        logs.append(log_p)
        devs = deviations(log_p, value, np.where(has, begin + 1, 1 << 60), salt)
        open_sets.append(devs)


def units_of(data: np.ndarray, offsets: np.ndarray):
    """Text with a blank before every non-empty row, its row offsets, the first byte of every
    unit, its end, and the first unit of every row."""
    sizes = np.diff(offsets)
    some = sizes > 0
    out_offsets = np.concatenate([[0], np.cumsum(sizes + some)])
    out = np.full(out_offsets[-1], BLANK, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.cumsum(some), sizes)] = data
    blank = out == BLANK
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[out_offsets[:-1][some]] = True
    begin = np.flatnonzero(start)
    return out, out_offsets, begin, np.append(begin[1:], len(out)), np.searchsorted(begin, out_offsets)


def _ids(lat: Lattice, v: Vocabulary, text: np.ndarray, edges: np.ndarray, byte_places: np.ndarray):
    """Ids of a path, characters without a piece spelled with bytes; and ids per edge."""
    piece = lat.piece[edges]
    spelled = piece < 0
    if not spelled.any():
        return piece, np.ones(len(piece), np.int64)
    size = np.where(spelled, lat.end[edges] - lat.start[edges], 1)
    out = np.repeat(piece, size)
    place = np.arange(len(out)) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(lat.start[edges], size) + place
    lost = np.repeat(spelled, size)
    out[lost] = v.byte_id[byte_places[at[lost]]]
    return out, size


def segment(proto: bytes, k: int, alpha: float, with_ids: bool, with_decoded: bool = False):
    """Arrow function: doc_id, text, _seed -> ids or their digests, samples, round trip, decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(proto, alpha)
        for batch in slices(batches, "text", SLICE):
            n = batch.num_rows
            data, offsets = text_bytes(batch.column("text"))
            text, row_cut, begin, end, first = units_of(data, offsets)
            seed = mix(batch.column("_seed").to_numpy().view(U64))
            # Distinct units by a 64-bit hash of their bytes.
            power = powers(len(text) + 1)
            run_hash = np.zeros(len(text) + 1, U64)
            np.cumsum(_BYTES[text] * power[0][: len(text)], out=run_hash[1:])
            key = mix((run_hash[end] - run_hash[begin]) * power[1][begin] + (end - begin).astype(U64) * U64(31))
            key, chosen, which = np.unique(key, return_index=True, return_inverse=True)
            size = (end - begin)[chosen]
            cut = np.concatenate([[0], np.cumsum(size)])
            place = np.arange(cut[-1]) - np.repeat(cut[:-1], size)
            spelled = text[np.repeat(begin[chosen], size) + place]
            own_first, own_size = v.own_ids(key, spelled.tobytes(), cut)
            good = np.ones(n, bool)
            wrong = ~_same(v, _runs(v.known_ids, own_first, own_size), np.concatenate([[0], np.cumsum(own_size)]), spelled, cut)
            if wrong.any():
                good[np.searchsorted(first, np.flatnonzero(wrong[which]), "right") - 1] = False
            ids = _runs(v.known_ids, own_first[which], own_size[which])
            ids_cut = np.concatenate([[0], np.cumsum(own_size[which])])[first]
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(ids_cut))}
            digest = [zlib.crc32(ids[a:b].astype("<i4").tobytes()) for a, b in zip(ids_cut[:-1], ids_cut[1:], strict=True)]
            columns["ids_crc32"] = pa.array(digest, pa.int64())
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ids_cut.astype(np.int32)), pa.array(ids.astype(np.int32)))
            made: list[tuple[np.ndarray, ...]] = []
            spelled_ids: list[np.ndarray] = []
            if k and len(begin):
                lat = Lattice(v, spelled, cut)
                paths, beyond = sample(lat, cut[:-1][which], first, seed, k)
                base = 0
                for edges, path_cut, has, log_p, value in paths:
                    ids, size = _ids(lat, v, text, edges, spelled)
                    ids_at = np.concatenate([[0], np.cumsum(size)])[path_cut[first]]
                    with np.errstate(over="ignore"):
                        inclusion = -np.expm1(-np.exp(log_p - beyond))
                    i = np.flatnonzero(has)
                    digest = [zlib.crc32(ids[a:b].astype("<i4").tobytes()) for a, b in zip(ids_at[i], ids_at[i + 1], strict=True)]
                    made.append((i, ids_at[i] + base, np.diff(ids_at)[i], log_p[i], value[i], inclusion[i], np.array(digest, np.int64)))
                    spelled_ids.append(ids.astype(np.int32))
                    base += len(ids)
            columns["samples"] = _sample_lists(made, spelled_ids, n, with_ids)
            columns["round_trip"] = pa.array(good)
            if with_decoded:
                columns["decoded"] = _decoded_same(v, columns["ids"], columns["samples"], batch.column("text"))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


_BYTES = numbers(31, 256)


def _sample_lists(made: list[tuple], ids: list[np.ndarray], rows: int, with_ids: bool) -> pa.Array:
    """The samples of every row in the order they were drawn, as a list of structs."""
    if made:
        row, first, size, log_p, value, inclusion, digest = map(np.concatenate, zip(*made, strict=True))
    else:
        row = first = size = digest = np.zeros(0, np.int64)
        log_p = value = inclusion = np.zeros(0)
    order = np.argsort(row, kind="stable")
    names = ["n_tokens", "log_p", "perturbed", "inclusion", "digest"]
    fields = [pa.array(x[order]) for x in (size, log_p, value, inclusion, digest)]
    if with_ids:
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        cut = np.concatenate([[0], np.cumsum(size[order])]).astype(np.int32)
        names.append("ids")
        fields.append(pa.ListArray.from_arrays(pa.array(cut), pa.array(_runs(flat, first[order], size[order]))))
    cut = np.searchsorted(row[order], np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays(fields, names))


def _runs(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[first : first + size]`` one after another."""
    start = np.repeat(first - (np.cumsum(size) - size), size)
    return flat[start + np.arange(len(start))]


def _same(v: Vocabulary, ids: np.ndarray, cut: np.ndarray, text: np.ndarray, row_cut: np.ndarray) -> np.ndarray:
    """Whether the ids of every row spell exactly the row's bytes."""
    sizes = np.concatenate([[0], np.cumsum(v.length[ids])])[cut]
    out = v.decoded(ids)
    if len(out) == len(text) and np.array_equal(sizes, row_cut):
        wrong = np.flatnonzero(out != text)
        good = np.ones(len(row_cut) - 1, bool)
        good[np.searchsorted(row_cut, wrong, "right") - 1] = False
        return good
    return np.array(
        [np.array_equal(out[a:b], text[c:d]) for a, b, c, d in zip(sizes, sizes[1:], row_cut, row_cut[1:], strict=False)], bool
    )


def texts_of(v: Vocabulary, ids: pa.ListArray) -> pa.Array:
    """The text that every list of ids spells; null counts as no ids."""
    flat = ids.flatten().to_numpy().astype(np.int64)
    first = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())])
    data = v.decoded(flat)
    cut = np.concatenate([[0], np.cumsum(v.length[flat])])[first]
    some = np.flatnonzero(np.diff(cut))
    if (data[cut[some]] == BLANK).all():
        inside = np.ones(len(data), bool)
        inside[cut[some]] = False  # the blank that encoding puts before a text
        ends = np.concatenate([[0], np.cumsum(np.diff(cut) > 0)])
        buffers = [None, pa.py_buffer((cut - ends).astype(np.int32)), pa.py_buffer(data[inside])]
        out = pa.Array.from_buffers(pa.string(), len(ids), buffers)
        try:
            out.validate(full=True)
            return out
        except pa.ArrowInvalid:  # ids that are no text
            pass
    raw = data.tobytes()
    return pa.array([raw[a:b].decode("utf-8", "replace")[1:] for a, b in zip(cut, cut[1:], strict=False)], pa.string())


def _decoded_same(v: Vocabulary, ids: pa.ListArray, samples: pa.ListArray, text: pa.Array) -> pa.Array:
    """Whether the ids of every row and those of each of its samples decode to its text."""
    text = pc.fill_null(text.cast(pa.string()), "")
    good = pc.equal(texts_of(v, ids), text).to_numpy(zero_copy_only=False).copy()
    row = np.repeat(np.arange(len(text)), pc.list_value_length(samples).to_numpy())
    for a in range(0, len(row), len(text)):
        part = samples.flatten().field("ids").slice(a, len(text))
        of = row[a : a + len(text)]
        good[of[~pc.equal(texts_of(v, part), text.take(pa.array(of))).to_numpy(zero_copy_only=False)]] = False
    return pa.array(good)


def encode(
    docs: DataFrame,
    model: str = MODEL,
    k: int = SAMPLES,
    alpha: float = ALPHA,
    with_ids: bool = True,
    with_decoded: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, (ids,) samples, round_trip (, decoded) for every row of ``docs``.

    Each sample has n_tokens, log_p, perturbed, inclusion, digest (, ids); they differ from each
    other.  A text with fewer segmentations has fewer samples; null and empty texts have no ids
    and no samples.  ``round_trip`` says that the ids
    spell the text again; ``decoded`` (with ids only) that they and the ids of every sample, decoded
    as ``decode`` does, give the text.  Rows with equal doc_id and text get equal results; a null doc_id is a key
    like any other.  Other columns are ignored; an empty table gives no rows.
    """
    if with_decoded and not with_ids:
        raise ValueError("with_decoded needs with_ids")
    with open(model, "rb") as file:  # on the driver; tasks get the bytes
        proto = file.read()
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = "ids array<int>, " if with_ids else ""
    inner = ", ids: array<int>" if with_ids else ""
    schema = (
        f"doc_id {kind}, n_tokens long, ids_crc32 long, {ids}samples array<struct<n_tokens: long, "
        f"log_p: double, perturbed: double, inclusion: double, digest: long{inner}>>, round_trip boolean"
        + (", decoded boolean" if with_decoded else "")
    )
    seed = F.xxhash64(F.col("doc_id").cast("string"))
    return docs.select("doc_id", "text", seed.alias("_seed")).mapInArrow(segment(proto, k, alpha, with_ids, with_decoded), schema)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids count as none."""
    with open(model, "rb") as file:
        proto = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(proto, ALPHA)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts_of(v, batch.column("ids"))], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
