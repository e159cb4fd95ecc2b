"""SentencePiece encoding and decoding: distinct sampled segmentations by Gumbel top-k search over the lattice."""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm import common

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
#: Places of the table of pieces' beginnings.
PLACES = 1 << 18
#: The blank that pieces begin with, and a number beyond all code points for that character in a text.
BLANK, LITERAL = "▁", 0x110000
#: Distinct chunks of text whose lattices a task remembers, and how many characters of them it makes at once.
CHUNK_CACHE, CACHE_CHARS, AT_ONCE = 100_000, 900_000, 50_000
SLICE_BYTES = 1 << 19
#: A chunk longer than this is cut where no piece crosses.
LONG = 48
#: States whose ln mass lies this far below the first one's are out of reach of a draw's 52 bits.
FAINT = 41.0

_GOLD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _MIX1
    z = (z ^ (z >> np.uint64(27))) * _MIX2
    return z ^ (z >> np.uint64(31))


def _uniform(z: np.ndarray) -> np.ndarray:
    """Above 0 and below 1."""
    return ((_mixed(z) >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


class Vocabulary:
    """Pieces of a model, with weights: ln P falls as in Zipf's law with the rank that the model's scores give.

    A character that is no piece is written as pieces for its bytes, which get numbers of their own beyond the model's.
    """

    def __init__(self, model: bytes, theta: float = 1.0) -> None:
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = m.get_piece_size()
        self.data: list[bytes] = []
        self.byte = [0] * 256
        by_text: dict[str, int] = {}
        scores = np.array([m.get_score(i) for i in range(self.size)])
        usable = [i for i in range(self.size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        rank = {i: r for r, i in enumerate(sorted(usable, key=lambda i: (-scores[i], i)))}
        self.log = np.full(self.size, -np.inf)
        for i in range(self.size):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.data.append(bytes([int(piece[3:5], 16)]))
            elif i in rank:
                by_text[piece] = i
                self.log[i] = -theta * math.log(rank[i] + 10)
                self.data.append(piece.replace(BLANK, " ").encode())
            else:
                self.data.append(b"")
        self.byte_log = -theta * math.log(len(usable) + 10)
        self.spelled: dict[int, int] = {}  # by character: the number for its bytes
        self.bytes_of: list[list[int]] = []
        self.longest = max(map(len, by_text))
        prefixes: dict[int, int] = {}
        pairs = set()
        for piece, i in by_text.items():
            h = np.uint64(0)
            codes = np.array([ord(c) for c in piece], np.uint64)
            with np.errstate(over="ignore"):
                for c in codes:
                    h = self._step(h, c)
                    prefixes.setdefault(int(h), -1)
            prefixes[int(h)] = i
            pairs.update(zip(piece, piece[1:]))
        # a table by the hash's low bits, with the few others of a place behind it
        keys = np.array(sorted(prefixes), np.uint64)
        values = np.array([prefixes[int(h)] for h in keys], np.int64)
        self.mask = np.uint64(PLACES - 1)
        place = (keys & self.mask).astype(np.int64)
        order = np.argsort(place, kind="stable")
        rank = np.arange(len(keys)) - np.searchsorted(place[order], place[order])
        self.slots = [(np.zeros(PLACES, np.uint64), np.full(PLACES, -2, np.int32)) for _ in range(int(rank.max()) + 1)]
        for r, (slot_key, slot_value) in enumerate(self.slots):
            own = order[rank == r]
            slot_key[place[own]], slot_value[place[own]] = keys[own], values[own]
        self.pairs = pairs
        # no piece has a line end, nor one of these marks behind a letter or digit
        self.marks = "".join(c for c in ",.;:!?" if not any(b == c and a.isalnum() for a, b in pairs))
        end = "" if any("\n" in x for x in pairs) else r"\n"
        stop = f"{BLANK}{re.escape(self.marks)}{end}"
        self.parts = re.compile("|".join([f"{BLANK}*[^{stop}]+", *[end] * bool(end), *[f"{BLANK}*[{re.escape(self.marks)}]+[^{stop}]*"] * bool(self.marks), f"{BLANK}+"]))

    @staticmethod
    def _step(h, c):
        z = (h ^ (c + _GOLD)) * _MIX1
        return z ^ (z >> np.uint64(29))

    def find(self, h: np.ndarray) -> np.ndarray:
        """For hashes of texts: the piece, -1 for the beginning of one only, -2 for neither."""
        at = (h & self.mask).astype(np.int64)
        slot_key, slot_value = self.slots[0]
        out = np.where(slot_key[at] == h, slot_value[at], np.int32(-2))
        rest = np.flatnonzero(out == -2)
        for slot_key, slot_value in self.slots[1:]:  # ever fewer places have a further slot
            rest = rest[slot_key[at[rest]] != 0]
            hit = slot_key[at[rest]] == h[rest]
            out[rest[hit]] = slot_value[at[rest[hit]]]
            rest = rest[~hit]
        return out

    def spell(self, code: int) -> int:
        """The number for a character's bytes."""
        if code not in self.spelled:
            data = (BLANK if code == LITERAL else chr(code)).encode()
            if len(data) == 1:
                self.spelled[code] = self.byte[data[0]]
                self.log[self.byte[data[0]]] = self.byte_log
            else:
                self.spelled[code] = self.size + len(self.bytes_of)
                self.bytes_of.append([self.byte[b] for b in data])
                self.log = np.append(self.log, len(data) * self.byte_log)
        return self.spelled[code]

    def chunks(self, text: str) -> list[str]:
        """Parts of a text, with blanks written as the model writes them, that no piece crosses."""
        if not text:
            return []
        if BLANK in text:
            text = text.replace(BLANK, "\ud800")  # no text has a lone surrogate
        out = self.parts.findall(BLANK + text.replace(" ", BLANK))
        marked = [i for i, c in enumerate(out) if c[0] in self.marks]
        if bad := [i for i in marked if i and not out[i - 1][-1].isalnum()]:  # a piece may cross here
            for i in reversed(bad):
                if out[i - 1] != "\n":
                    out[i - 1 : i + 1] = [out[i - 1] + out[i]]
        if max(map(len, out)) > LONG:
            out = [part for w in out for part in (self._cut(w) if len(w) > LONG else (w,))]
        return out

    def _cut(self, chunk: str) -> Iterator[str]:
        start = 0
        for i in range(1, len(chunk)):
            if (chunk[i - 1], chunk[i]) not in self.pairs:
                yield chunk[start:i]
                start = i
        yield chunk[start:]

    def expanded(self, ids: np.ndarray) -> np.ndarray:
        """ids of the model only: characters spelled by bytes become those."""
        if not len(ids) or ids.max() < self.size:
            return ids
        return np.array([j for i in ids.tolist() for j in (self.bytes_of[i - self.size] if i >= self.size else (i,))], np.int32)

    def decode(self, ids) -> str:
        return b"".join(map(self.data.__getitem__, ids))[1:].decode("utf-8", "replace")


class Lattices:
    """Lattices of chunks, one after another. Each character, and each chunk's end, is a place; the pieces that start at a
    place are its edges, by length, with their shares among all ways to go on from there, summed up."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.chunks = self.places = self.edges = 0
        self.start, self.end = np.zeros(1, np.int64), np.zeros(1, np.int64)  # of chunks: their places
        self.total = np.zeros(1)  # ln of a chunk's weight over all its segmentations
        self.edge = np.zeros(1, np.int32)  # of places: the first edge
        self.ways = np.zeros(1, np.float32)  # of places: how many segmentations go on from there
        self.upto = np.zeros(1, np.float32)
        self.id, self.length = np.zeros(1, np.int32), np.zeros(1, np.int16)

    def numbers(self, chunks: list[str]) -> np.ndarray:
        if len(self.number) > CHUNK_CACHE or self.places > CACHE_CHARS:
            self.clear()
        known = self.number
        out = np.fromiter(map(known.get, chunks, itertools.repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(out < 0)
        if not len(missing):
            return out
        wanted = [chunks[i] for i in missing.tolist()]
        new = list(dict.fromkeys(wanted))
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        sizes = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        cuts = [0, *np.flatnonzero(np.diff(sizes // AT_ONCE)).tolist(), len(new)]
        self._append([self._made(new[x:y]) for x, y in itertools.pairwise(dict.fromkeys(cuts)) if y > x])
        out[missing] = np.fromiter(map(known.__getitem__, wanted), np.int64, len(wanted))
        return out

    def _append(self, made: list[dict]) -> None:
        for m in made:
            m["start"], m["end"], m["edge"] = m["start"] + self.places, m["end"] + self.places, m["edge"][1:] + self.edges
            for name, at in (("start", self.chunks), ("end", self.chunks), ("total", self.chunks), ("ways", self.places), ("edge", self.places + 1), ("upto", self.edges), ("id", self.edges), ("length", self.edges)):
                own, new = getattr(self, name), m[name]
                if at + len(new) > len(own):  # twice the room, so that copying stays in proportion
                    own = np.concatenate([own[:at], np.zeros(max(len(new), at + 1024), own.dtype)])
                    setattr(self, name, own)
                own[at : at + len(new)] = new
            self.chunks, self.places, self.edges = self.chunks + len(m["total"]), self.places + len(m["ways"]), self.edges + len(m["upto"])

    def _made(self, new: list[str]) -> dict[str, np.ndarray]:
        v = self.v
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        last = np.cumsum(sizes + 1) - 1
        first = last - sizes
        codes = np.zeros(int(last[-1]) + 1, np.uint64)
        inside = np.ones(len(codes), bool)
        inside[last] = False
        codes[inside] = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes[codes == 0xD800] = LITERAL
        left = np.repeat(last, sizes + 1) - np.arange(len(codes))
        places, lengths, ids = [], [], []
        at = np.flatnonzero(inside)
        h = np.zeros(len(at), np.uint64)
        for k in range(v.longest):
            ok = left[at] > k
            at, h = at[ok], h[ok]
            if not len(at):
                break
            h = v._step(h, codes[at + k])
            found = v.find(h)
            ok = found >= -1
            at, h, found = at[ok], h[ok], found[ok]
            whole = found >= 0
            if not k:
                single = np.zeros(len(codes), bool)
                single[at[whole]] = True
            places.append(at[whole]), ids.append(found[whole]), lengths.append(np.full(int(whole.sum()), k + 1, np.int64))
        alone = np.flatnonzero(inside & ~single)
        places.append(alone), lengths.append(np.ones(len(alone), np.int64))
        ids.append(np.array([v.spell(int(c)) for c in codes[alone]], np.int64))
        place, length, id_ = np.concatenate(places), np.concatenate(lengths), np.concatenate(ids)
        # from the chunks' ends back: the weight of all ways to go on, and how many there are
        order = np.argsort(left[place] * (64 * len(codes)) + place * 64 + length)
        place, length, id_ = place[order], length[order], id_[order]
        weight, to = v.log[id_], place + length
        total, ways = np.zeros(len(codes)), np.ones(len(codes))
        new_place = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        by_left = left[place[new_place]]
        bounds = np.searchsorted(by_left, np.arange(1, int(left.max()) + 2))
        ends = np.r_[new_place, len(place)]
        for n in range(len(bounds) - 1):
            a, b = bounds[n], bounds[n + 1]
            e = slice(ends[a], ends[b])
            on, starts = weight[e] + total[to[e]], new_place[a:b] - ends[a]
            top = np.maximum.reduceat(on, starts)
            rows = place[new_place[a:b]]
            total[rows] = top + np.log(np.add.reduceat(np.exp(on - np.repeat(top, np.diff(ends[a : b + 1]))), starts))
            ways[rows] = np.add.reduceat(ways[to[e]], starts)
        share = np.exp(weight + total[to] - total[place])
        order = np.argsort(place, kind="stable")
        place, length, id_, share = place[order], length[order], id_[order], share[order]
        edge = np.r_[0, np.cumsum(np.bincount(place, minlength=len(codes)))]
        upto = np.cumsum(share)
        upto -= np.r_[0, upto][edge[place]]
        upto[edge[1:][inside] - 1] = 2  # above every draw
        return {"start": first, "end": last, "total": total[first], "ways": ways, "edge": edge, "upto": upto.astype(np.float32), "id": id_.astype(np.int32), "length": length.astype(np.int16)}

    def sample(self, chunk: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A segmentation of each chunk, drawn by its probability: ids of all chunks one after another, their numbers, and
        ln P of each. The draws of a chunk depend on its seed only."""
        at, end = self.start[chunk], self.end[chunk]
        counts, rows, steps = np.zeros(len(chunk), np.int64), np.arange(len(chunk)), []
        while len(rows):
            if len(steps) % 2:  # a hash is enough for two draws
                u = ((bits >> np.uint64(12)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2.0**-24)
            else:
                bits = _mixed(seed)
                u = (bits >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
            e = self.edge[at]
            more = np.flatnonzero(self.upto[e] <= u)
            while len(more):
                e[more] += 1
                more = more[self.upto[e[more]] <= u[more]]
            steps.append((rows, self.id[e]))
            at = at + self.length[e]
            going = np.flatnonzero(at < end)
            counts[rows] = len(steps)
            rows, at, end, bits = rows[going], at[going], end[going], bits[going]
            seed = seed[going]
            if not len(steps) % 2:
                seed = seed + _GOLD
        first = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for k, (rows, ids) in enumerate(steps):
            out[first[rows] + k] = ids
        log = np.add.reduceat(self.v.log[out], first) - self.total[chunk] if len(chunk) else np.zeros(0)
        return out, counts, np.minimum(log, 0)

    def sample_other(self, chunk: int, excluded: list[tuple[int, ...]], seed: np.uint64) -> tuple[tuple[int, ...], float]:
        """A segmentation of one chunk besides the excluded ones, and its ln P; drawn by probability among the others."""
        at, end = int(self.start[chunk]), int(self.end[chunk])
        draws = iter(_uniform(seed + np.arange(end - at, dtype=np.uint64) * _GOLD).tolist())
        out: list[int] = []
        rest = list(excluded)
        while at < end:
            a, b = self.edge[at], self.edge[at + 1]
            mass, pieces, lengths = self.upto[a:b].tolist(), self.id[a:b].tolist(), self.length[a:b].tolist()
            mass[-1] = 1.0
            mass = [x - y for x, y in zip(mass, [0.0, *mass], strict=False)]
            for j, piece in enumerate(pieces if rest else ()):
                own = [x for x in rest if x[0] == piece]
                if own:
                    left = self.ways[at + lengths[j]] - len(own)
                    mass[j] = 0.0 if left < 0.5 else max(1e-30, mass[j] - sum(self._share(at, x) for x in own))
            u, j = next(draws) * sum(mass), 0
            while u >= mass[j] and any(mass[j + 1 :]):
                u -= mass[j]
                j += 1
            while mass[j] == 0:
                j -= 1
            out.append(pieces[j])
            rest = [x[1:] for x in rest if x[0] == pieces[j] and len(x) > 1]
            at += lengths[j]
        return tuple(out), min(0.0, float(self.v.log[out].sum() - self.total[chunk]))

    def _share(self, at: int, ids: tuple[int, ...]) -> float:
        """P of going on from a place by these pieces."""
        p = 1.0
        for i in ids:
            a, b = self.edge[at], self.edge[at + 1]
            n = int(np.flatnonzero(self.id[a:b] == i)[0])
            p *= min(1.0, float(self.upto[a + n])) - (float(self.upto[a + n - 1]) if n else 0.0)
            at += int(self.length[a + n])
        return p


@dataclass
class Path:
    """A segmentation: the ids of all chunks, how many each has, ln P by chunk, and the perturbed ln P of the whole."""

    ids: np.ndarray
    counts: np.ndarray
    log: np.ndarray
    gumbel: float

    def before(self, i: int) -> int:
        """Ids of the chunks before chunk i."""
        return int(self.counts[:i].sum())

    def of(self, i: int) -> tuple[int, ...]:
        a = self.before(i)
        return tuple(self.ids[a : a + int(self.counts[i])].tolist())


class Search:
    """Best-first search of one text's segmentations in the order of their perturbed log-probabilities, without
    replacement.

    A state of the frontier is the set of segmentations that begin like a path already found, differ from it in chunk i,
    and are free after that. Its priority is the largest perturbed log-probability in the set: a Gumbel variable at
    the log of the set's mass, which the lattice gives exactly, truncated at the path's own. Taking the best state finds
    its best segmentation, whose other parts become states in turn.
    """

    def __init__(self, lattices: Lattices, chunks: np.ndarray, seed: np.uint64) -> None:
        self.l, self.chunks, self.seed, self.n = lattices, chunks, seed, 0
        self.ways = lattices.ways[lattices.start[chunks]]
        self.frontier: list[tuple[float, int, int, int, list]] = []  # -priority, tie, path, chunk, excluded
        self.found: list[Path] = []

    def first(self, ids: np.ndarray, counts: np.ndarray, log: np.ndarray) -> tuple[Path, int, list]:
        """The best segmentation of all, a plain draw; its perturbed ln P is a Gumbel variable at ln 1."""
        self.n += 1
        u = _uniform(_mixed(self.seed + np.array([self.n], np.uint64) * _MIX2))[0]
        self.found.append(Path(ids, counts, log, float(-np.log(-np.log(u)))))
        return self.found[-1], 0, []

    def threshold(self) -> float:
        """The largest perturbed ln P that is still to be found."""
        return -self.frontier[0][0] if self.frontier else -math.inf

    def pop(self) -> tuple[Path, int, list, float, tuple[int, ...], float]:
        """The best state, with its new segmentation of the chunk that must differ; the chunks after it are to be drawn."""
        value, _, k, i, rule = heapq.heappop(self.frontier)
        seed = _mixed(self.seed + np.array([len(self.found) + 1], np.uint64) * _MIX1)[0]
        return self.found[k], i, rule, -value, *self.l.sample_other(int(self.chunks[i]), rule, seed)

    def close(self, state: tuple, ids: np.ndarray, counts: np.ndarray, log: np.ndarray) -> tuple[Path, int, list]:
        """Take the segmentation of a popped state, with the draws of the chunks after it."""
        path, i, rule, value, own, own_log = state
        ids = np.concatenate([path.ids[: path.before(i)], np.array(own, np.int32), ids])
        self.found.append(Path(ids, np.concatenate([path.counts[:i], [len(own)], counts]), np.concatenate([path.log[:i], [own_log], log]), value))
        return self.found[-1], i, rule


def split(lattices: Lattices, new: list[tuple[Search, Path, int, list]], samples: int) -> None:
    """For new paths, each free from a chunk `since` on where some ways had been ruled out: push the states that are left, a
    state for each chunk in which another segmentation may differ first. For all texts at once.

    States behind a prefix whose ln mass has fallen by FAINT are left out: a draw would reach one of them with a probability
    of about exp(-FAINT), which is less than its 52 bits tell apart."""
    new = [(s, p, i, gone) for s, p, i, gone in new if i < len(s.chunks)]
    if not new:
        return
    since = np.array([i for _, _, i, _ in new])
    log = np.concatenate([p.log[i:] for _, p, i, _ in new])
    sizes = np.array([len(p.log) - i for _, p, i, _ in new])
    first = np.cumsum(sizes) - sizes
    ahead = np.concatenate([np.cumsum(p.log[i:]) for _, p, i, _ in new]) - log  # text by text, whatever comes with it
    at = np.flatnonzero(ahead >= -FAINT)
    of = np.searchsorted(first, at, side="right") - 1
    log, place = log[at], at - first[of]
    ahead = ahead[at] + np.array([p.log[:i].sum() for _, p, i, _ in new])[of]
    chunk = np.concatenate([s.chunks[i:] for s, _, i, _ in new])[at]
    with np.errstate(divide="ignore"):
        other = np.where(lattices.ways[lattices.start[chunk]] > 1.5, np.log(-np.expm1(log)), -np.inf)
    rules = [[*gone, p.of(i)] for _, p, i, gone in new]
    begins = np.searchsorted(of, np.arange(len(new)))
    for t, (s, _, i, gone) in enumerate(new):
        if gone:
            chunk_ = s.chunks[i]
            p = sum(math.exp(min(0.0, float(lattices.v.log[list(x)].sum() - lattices.total[chunk_]))) for x in rules[t])
            other[begins[t]] = math.log(max(1e-300, 1 - p)) if s.ways[i] - len(rules[t]) > 0.5 else -np.inf
        s.n += 1
    mass = ahead + other
    seeds = _mixed(np.array([s.seed for s, _, _, _ in new], np.uint64) + np.array([s.n for s, _, _, _ in new], np.uint64) * _MIX2)
    ok = np.flatnonzero(np.isfinite(mass))
    of, place, mass = of[ok], place[ok], mass[ok]
    u = _uniform(seeds[of] + place.astype(np.uint64) * _GOLD)
    value = -np.logaddexp(-np.array([p.gumbel for _, p, _, _ in new])[of], np.log(-np.log(u)) - mass)
    order = np.lexsort((place, -value, of))
    of, place, value = of[order], place[order], value[order]
    # at most as many states of a path are ever taken as samples are asked for, and one more for the threshold
    best = np.flatnonzero(np.arange(len(of)) - np.searchsorted(of, of) < samples)
    for t, i, x in zip(of[best].tolist(), place[best].tolist(), value[best].tolist(), strict=True):
        s, path, begin, _ = new[t]
        rule = rules[t] if i == 0 else [path.of(begin + i)]
        heapq.heappush(s.frontier, (-x, len(s.found) * 1_000_000 + i, len(s.found) - 1, begin + i, rule))


def encode_slice(lattices: Lattices, texts: list[str], seeds: list[int], samples: int) -> list[list[tuple]]:
    """For every text, up to `samples` distinct segmentations as (ids, ln P, perturbed ln P, ln of the inclusion
    probability), in the order of the perturbed ln P. Each draw depends on the text's seed only."""
    parts = [lattices.v.chunks(t) for t in texts]
    chunk = lattices.numbers([c for p in parts for c in p])
    ends = np.cumsum([len(p) for p in parts])
    seeds_ = np.array(seeds, np.uint64)
    searches = [Search(lattices, chunk[e - len(p) : e], s) for p, e, s in zip(parts, ends, seeds_, strict=True)]
    salts = np.arange(max(map(len, parts), default=0) + 1, dtype=np.uint64)

    def drawn(todo: list[tuple[int, int]], turn: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Plain draws of the chunks of text t from the i-th on, for all (t, i) at once."""
        which = [searches[t].chunks[i:] for t, i in todo]
        own = _mixed(seeds_[[t for t, _ in todo]] + np.array([turn + 1], np.uint64) * _MIX2)
        seed = np.concatenate([_mixed(o ^ (salts[i : i + len(w)] * _GOLD)) for o, (_, i), w in zip(own, todo, which, strict=True)])
        ids, counts, log = lattices.sample(np.concatenate(which), seed)
        upto = np.concatenate([[0], np.cumsum(counts)])
        a = 0
        for w in which:
            b = a + len(w)
            yield ids[upto[a] : upto[b]], counts[a:b], log[a:b]
            a = b

    if texts:
        split(lattices, [(s, *s.first(*d)) for s, d in zip(searches, drawn([(t, 0) for t in range(len(texts))], 0), strict=True)], samples)
    for turn in range(1, samples):
        states = [(t, s.pop()) for t, s in enumerate(searches) if s.frontier]
        if states:
            split(lattices, [(searches[t], *searches[t].close(state, *d)) for (t, state), d in zip(states, drawn([(t, state[1] + 1) for t, state in states], turn), strict=True)], samples)
    out = []
    for s in searches:
        most, rows = s.threshold(), []
        for path in s.found:
            log = float(path.log.sum())
            x = math.exp(min(50.0, log - most)) if most > -math.inf else math.inf
            rows.append((lattices.v.expanded(path.ids), log, path.gumbel, math.log(-math.expm1(-x)) if 1e-12 < x < 700 else min(0.0, log - most) if x < 1 else 0.0))
        out.append(rows)
    return out


SAMPLE = "sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, round_trip boolean"


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, samples: int = SAMPLES, model: str = MODEL, theta: float = 1.0) -> DataFrame:
    """The columns `keep` (by default the key) and SAMPLE, a row for each distinct sampled segmentation of every whole text.

    Segmentations are sampled without replacement: ids of the model's pieces whose joined texts are the text, with ln P,
    perturbed ln P and ln of the probability that a search with this threshold includes them. Draws are seeded by the
    row's key, so equal rows get equal samples and reruns agree. Null texts are empty; an empty text has one
    segmentation, of no pieces; texts with fewer segmentations than samples give all of theirs. Null keys share a seed.
    States of the search that a draw reaches with a probability of about exp(-FAINT) at most are left out.
    The model is read by the driver and sent to the tasks. One pass, no shuffle.
    """
    common.bounded_batches(docs.sparkSession)
    kept = [key] if keep is None else [c for c in keep if c not in [f.split()[0] for f in SAMPLE.split(", ")]]
    own_key, own_text = common.free_name("own_key", kept), common.free_name("own_text", kept)
    source = docs.select(*kept, F.coalesce(docs[key].cast("string"), F.lit("")).alias(own_key), docs[text].alias(own_text))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-2]] + [SAMPLE])
    with open(model, "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        vocabulary = Vocabulary(data.value, theta)
        lattices = Lattices(vocabulary)
        for batch in batches:
            for part in common.slices(batch, own_text, SLICE_BYTES):
                texts = [t or "" for t in part.column(own_text).to_pylist()]
                found = encode_slice(lattices, texts, [xxhash.xxh64_intdigest(k) for k in part.column(own_key).to_pylist()], samples)
                rows = [(i, n + 1, *row, vocabulary.decode(row[0].tolist()) == texts[i]) for i, each in enumerate(found) for n, row in enumerate(each)]
                at = pa.array([r[0] for r in rows], pa.int64())
                ids = [r[2] for r in rows]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)), pa.array(np.concatenate(ids) if ids else [], pa.int32()))
                rest = [pa.array([r[j] for r in rows], k) for j, k in ((3, pa.float64()), (4, pa.float64()), (5, pa.float64()), (6, pa.bool_()))]
                yield pa.RecordBatch.from_arrays([c.take(at) for c in part.columns[:-2]] + [pa.array([r[1] for r in rows], pa.int32()), lists, *rest], names=kept + [f.split()[0] for f in SAMPLE.split(", ")])

    return source.mapInArrow(run, schema)


def decode(rows: DataFrame, ids: str = "ids", to: str = "decoded", model: str = MODEL) -> DataFrame:
    """Add the text that a row's ids stand for; null ids give null. Columns of that name are replaced."""
    common.bounded_batches(rows.sparkSession)
    kept = [c for c in rows.columns if c != to]
    source = rows.select(*kept)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields] + [f"`{to}` string"])
    with open(model, "rb") as file:
        data = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        vocabulary = Vocabulary(data.value)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=kept + [to])

    return source.mapInArrow(run, schema)


def op7_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    return encode(common.table(spark, sf_dir, "documents"))
