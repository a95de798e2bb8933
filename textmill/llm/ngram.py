"""Language-model scoring with an n-gram trie in Elias-Fano form.

The levels are files in the shared folder, memory-mapped by the scoring workers:

* words: sorted 64-bit hashes and counts, in shards by the hash's first bits; a word's id is its place in the order of all hashes;
* pairs and triples: the children of an n-gram are a range of the next level. The ranges' bounds are a monotone sequence in Elias-Fano
  form; so are the children's word ids, after the last one of the range before is added to those of each range. Each child has its
  probability, and each context its back-off weight, as one byte of 256 quantised levels.

A child is found by successor search inside its context's range: the sequence's high bits give the few places with the wanted high part, its low bits the
place. Probabilities are smoothed by absolute discounting with interpolation, so those of a context sum to one; unigrams are add-one over
all words. Every n-gram of the training documents is kept, those seen once as well.

Counting takes one shuffle. Documents are kept as codes (word ids) once the words have ids. A worker sorts the triples of a block of tokens,
and sends each shard its part as one compressed row; the last pair of a document goes as a triple without third word, so the
pairs' counts are sums over their triples. Shards of pairs and triples are ranges of the first two words, cut so that each gets about ``SHARD_TOKENS`` tokens
by the words' counts; a word with more is split by its second words, and the weights of these few words are added up on the driver.

Cases: null and empty texts are one end token; an empty training set scores every token at 1 in 1 (log 0, N = 0); a repeated or null
id has a result for each row, and a null id counts as training; equal texts count as often as they occur; a very long text is one block; further columns are not read; two words with one 64-bit hash would be one (never seen; about
n^2 / 2^65); more than 2^32 - 2 different words are refused with an error.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import base_documents, materialize, remove, shared_dir, store

DISCOUNT = 0.75
#: Words of a shard of level 1, and training tokens of a shard of the others, about.
SHARD_WORDS = 125_000
SHARD_TOKENS = 1_000_000
#: Tokens handled at once by a worker, but for a longer document.
BLOCK = 1_000_000
CACHED_WORDS = 400_000
#: Bytes of shards that a worker keeps open.
HELD_BYTES = 192 << 20
END = b" "  # no word has a space
#: Code of a word that training has not seen, and third word of a pair that ends its document.
NONE = (1 << 32) - 1
#: Bits of a word's place in a block's own list, if three of them fit in 64.
LOCAL = 21


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = self[word] = xxhash.xxh3_64_intdigest(word, 7)
        return found


_WORDS = _Hashes()


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words of a text with A-Z lower-cased, then that of the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    words.append(END)
    if len(_WORDS) > CACHED_WORDS:
        _WORDS.clear()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def blocks(batches: Iterator[pa.RecordBatch], read) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """ids, tokens and first positions of groups of whole documents; ``read`` makes the tokens of a value of the second column."""
    ids, parts, size = [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            ids.append(batch.column(0)[i].as_py())
            parts.append(read(batch.column(1)[i]))
            size += len(parts[-1])
            if size >= BLOCK:
                yield ids, np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts[:-1]])
                ids, parts, size = [], [], 0
    if ids:
        yield ids, np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts[:-1]])


def hashed(value: pa.Scalar) -> np.ndarray:
    return tokens(value.as_py())


def coded(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<u4")


def _nth(word: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Place of the ``rest``-th (from 0) one of each 64-bit word."""
    place = np.zeros(len(word), np.int64)
    for width in (32, 16, 8, 4, 2, 1):  # the half that holds the wanted one
        part = (word >> place.astype(np.uint64)) & np.uint64((1 << width) - 1)
        ones = np.bitwise_count(part).astype(np.int64)
        up = rest >= ones
        rest = np.where(up, rest - ones, rest)
        place = np.where(up, place + width, place)
    return place


class EliasFano:
    """A monotone sequence of integers. Arrays: low (bytes of the low bits), high (64-bit words), rank (ones before each word), meta (size, low bits)."""

    @staticmethod
    def build(values: np.ndarray) -> dict[str, np.ndarray]:
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, int(np.log2(max(1, top // max(1, n)))))
        bits = 0 if bits < 4 else 8 if bits < 12 else 16 if bits < 20 else 32  # whole bytes
        low = (values & ((1 << bits) - 1)).astype({0: "u1", 8: "u1", 16: "u2", 32: "u4"}[bits]) if bits else np.zeros(0, "u1")
        ones = (values >> bits) + np.arange(n)
        high = np.zeros(int((top >> bits) + n) // 64 + 1, np.uint64)
        np.bitwise_or.at(high, ones // 64, np.uint64(1) << (ones % 64).astype(np.uint64))
        rank = np.cumsum(np.bitwise_count(high), dtype=np.int64) - np.bitwise_count(high)
        return {"low": low, "high": high, "rank": rank.astype("u4"), "meta": np.array([n, bits], np.int64)}

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.low, self.high, self.rank = arrays["low"], arrays["high"], arrays["rank"]
        self.size, self.bits = (int(x) for x in arrays["meta"])
        self.zeros: np.ndarray | None = None  # before each word

    def get(self, i: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.rank, i.astype(np.uint32), side="right") - 1
        value = (at * 64 + _nth(self.high[at], i - self.rank[at]) - i) << self.bits
        return value | self.low[i].astype(np.int64) if self.bits else value

    def _below(self, high: np.ndarray) -> np.ndarray:
        """Number of values whose high part is below ``high``."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.high), dtype=np.int64) * 64 - self.rank
        k = high - 1  # the zero that ends the part before
        at = np.maximum(np.searchsorted(self.zeros, k, side="right") - 1, 0)
        place = at * 64 + _nth(~self.high[at], np.maximum(k - self.zeros[at], 0))
        # Behind the last one there are no more parts.
        return np.where(high <= 0, 0, np.minimum(place - k, self.size))

    def find(self, low: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The first place from ``low`` to ``end`` that has ``value``, or -1, by the successor of ``value``."""
        high = value >> self.bits
        low, end = np.maximum(low, self._below(high)), np.minimum(end, self._below(high + 1))
        if not self.bits:
            return np.where(low < end, low, -1)
        want, last = (value & ((1 << self.bits) - 1)).astype(self.low.dtype), end.copy()
        open_ = np.flatnonzero(low < end)
        while len(open_):
            lo, hi = low[open_], end[open_]
            mid = (lo + hi) >> 1
            less = self.low[mid] < want[open_]
            low[open_] = lo = np.where(less, mid + 1, lo)
            end[open_] = hi = np.where(less, hi, mid)
            open_ = open_[lo < hi]
        hit = low < last
        hit[hit] = self.low[low[hit]] == want[hit]
        return np.where(hit, low, -1)


def codebook(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """256 levels at the quantiles, and each value's nearest level."""
    levels = np.unique(np.quantile(values, np.linspace(0, 1, 256))) if len(values) else np.zeros(1)
    mids = (levels[1:] + levels[:-1]) / 2
    out = np.zeros(256)
    out[: len(levels)] = levels
    return out, np.searchsorted(mids, values).astype(np.uint8)


# Files: a shard is one file of arrays end to end, after a line that names them. -------------------


def save(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays to ``uri``. The file is complete when it has its name, and a repeated attempt writes the same bytes."""
    files, path = store(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    at, index = 0, {}
    for name, array in arrays.items():
        index[name] = (array.dtype.str, at, len(array))
        at += -(-array.nbytes // 8) * 8
    head = json.dumps(index).encode()
    head += b" " * (-(len(head) + 9) % 8) + b"\n"
    part = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for array in arrays.values():
            out.write(array.tobytes() + bytes(-array.nbytes % 8))
    files.move(part, path)


def load(uri: str) -> dict[str, np.ndarray]:
    """Arrays of ``uri``, or none: mapped if the folder is local to all, read otherwise."""
    from pyarrow import fs

    files, path = store(uri)
    if files.get_file_info(path).type == fs.FileType.NotFound:
        return {}
    if isinstance(files, fs.LocalFileSystem):
        raw = np.memmap(path, np.uint8, "r")
    else:
        with files.open_input_file(path) as f:
            raw = np.frombuffer(f.read(), np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    body = raw[8 + size :]
    return {name: body[at : at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, at, n) in json.loads(raw[8 : 8 + size].tobytes()).items()}


class Trie:
    """The levels below ``uri``.

    ``first`` has the id of the first word of each shard of level 1, and the number of words; ``bounds`` the first pair (as one
    number) of each shard of the others; ``split`` and ``split_back`` words whose pairs lie in several shards, and their back-off weights.
    """

    def __init__(self, uri: str, bits: int, first: np.ndarray, total: int):
        self.uri, self.bits, self.first, self.total = uri, bits, first, total
        self.types = int(first[-1])
        self.bounds, self.split, self.split_back = np.zeros(1, np.uint64), np.zeros(0, np.int64), np.zeros(0)
        self.open: OrderedDict[str, dict] = OrderedDict()
        self.held = 0

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": OrderedDict(), "held": 0}

    def shard(self, name: str) -> dict:
        """Arrays of a file; those used least recently are closed when too much is open."""
        if name in self.open:
            self.open.move_to_end(name)
            return self.open[name]
        arrays: dict = load(f"{self.uri}/{name}")
        self.held += sum(a.nbytes for a in arrays.values())
        for kind in ("pairs", "words2", "triples", "words3"):
            own = {k.rpartition(".")[2]: v for k, v in arrays.items() if k.startswith(f"{kind}.")}
            if own:
                arrays[kind] = EliasFano(own)
        self.open[name] = arrays
        while self.held > HELD_BYTES and len(self.open) > 1:
            old = self.open.popitem(last=False)[1]
            self.held -= sum(a.nbytes for a in old.values() if isinstance(a, np.ndarray))
        return arrays

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted distinct hashes (NONE: unknown)."""
        ids = np.full(len(hashes), NONE, np.int64)
        own = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        for s, here in _runs(own):
            table = self.shard(f"1/{s}").get("hash", ())
            if len(table):
                at = np.minimum(np.searchsorted(table, hashes[here]), len(table) - 1)
                ids[here] = np.where(table[at] == hashes[here], at + self.first[s], NONE)
        return ids

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted ids (0: unknown)."""
        out = np.zeros(len(ids), np.int64)
        for s, here in _runs(np.searchsorted(self.first, ids, side="right") - 1):
            if s < len(self.first) - 1:
                out[here] = self.shard(f"1/{s}")["count"][ids[here] - self.first[s]]
        return out

    def range(self, s: int) -> tuple[int, int]:
        """First word of shard ``s``, and the one after its last."""
        last = int(self.bounds[s + 1]) if s + 1 < len(self.bounds) else self.types << 32
        return int(self.bounds[s]) >> 32, (last >> 32) + (last % (1 << 32) > 0)

    def backs(self, words: np.ndarray) -> np.ndarray:
        """Weights (log10) of one-word contexts, sorted; 0, all the mass, for those without children."""
        out = np.zeros(len(words))
        for s, here in _runs(np.searchsorted(self.bounds, words.astype(np.uint64) << np.uint64(32), side="right") - 1):
            table = self.shard(f"2/{s}")
            if "back2" in table:
                own = words[here] - self.range(s)[0]
                known = own < len(table["back2"])
                out[here] = np.where(known, table["back2_levels"][table["back2"][np.where(known, own, 0)]], 0.0)
        if len(self.split):
            at = np.minimum(np.searchsorted(self.split, words), len(self.split) - 1)
            out = np.where(self.split[at] == words, self.split_back[at], out)
        return out

    def pairs(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard, place in it (-1: not there) and probability (log10) of sorted distinct pairs of known words."""
        shard = np.searchsorted(self.bounds, _packed(first, second), side="right") - 1
        place, p = np.full(len(first), -1, np.int64), np.zeros(len(first))
        for s, here in _runs(shard):
            table = self.shard(f"2/{s}")
            if "pairs" in table:
                place[here] = _children(table["pairs"], table["words2"], first[here] - self.range(s)[0], second[here])
                hit = np.flatnonzero(place[here] >= 0) + here.start
                p[hit] = table["p2_levels"][table["p2"][place[hit]]]
        return shard, place, p

    def triples(self, shard: np.ndarray, pair: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether known pairs (sorted by shard and place) have the child, its probability, and the pairs' weights (log10)."""
        hit, p, back = np.zeros(len(pair), bool), np.zeros(len(pair)), np.zeros(len(pair))
        for s, here in _runs(shard):
            table = self.shard(f"2/{s}")
            back[here] = table["back3_levels"][table["back3"][pair[here]]]
            child = _children(table["triples"], table["words3"], pair[here], third[here])
            hit[here] = child >= 0
            p[here] = np.where(child >= 0, table["p3_levels"][table["p3"][np.maximum(child, 0)]] if len(table["p3"]) else 0.0, 0.0)
        return hit, p, back


def _runs(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers."""
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(shard)].tolist(), strict=True):
        if a < b:
            yield int(shard[a]), slice(a, b)


def _children(pointers: EliasFano, words: EliasFano, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Place of the child ``word`` of each ``parent`` (sorted), or -1."""
    fresh = np.r_[True, parent[1:] != parent[:-1]]
    own, of = parent[fresh], np.cumsum(fresh) - 1
    low, end = pointers.get(own), pointers.get(own + 1)
    base = np.where(low > 0, words.get(np.maximum(low - 1, 0)), 0) if words.size else np.zeros(len(own), np.int64)
    return words.find(low[of], end[of], base[of] + word)


def _level(parent: np.ndarray, word: np.ndarray, parents: int) -> tuple[dict, dict]:
    """Elias-Fano forms of the bounds and the word ids of children sorted by parent (0 to ``parents`` - 1) and word."""
    pointers = np.searchsorted(parent, np.arange(parents + 1))
    last = np.flatnonzero(np.r_[parent[1:] != parent[:-1], True]) if len(parent) else np.zeros(0, np.int64)
    base = np.r_[0, np.cumsum(word[last])[:-1]] if len(last) else np.zeros(0, np.int64)
    return EliasFano.build(pointers), EliasFano.build(word + np.repeat(base, np.diff(np.r_[-1, last])))


def _packed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)


# Level 1 ---------------------------------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, hashes, _ in blocks(batches, hashed):
        keys, counts = np.unique(hashes, return_counts=True)
        yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["k", "n"])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of each shard, from rows sorted by shard (the first column); one shard is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        for s, here in _runs(batch.column(0).to_numpy()):
            if s != last and held:
                yield last, held
                held = []
            last = s
            held.append(batch.slice(here.start, here.stop - here.start))
    if held:
        yield last, held


def _smallest(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _write_words(uri: str):
    """Writes level 1; gives for each shard its size (in row 0) and where shards of pairs begin: a word of the shard, and a share of its second words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            hashes, counts = (np.concatenate([r.column(k).to_numpy() for r in rows]) for k in (1, 2))
            hashes = hashes.view(np.uint64)
            order = np.argsort(hashes)  # Spark sorts them as signed
            hashes, counts = hashes[order], counts[order]
            save(f"{uri}/1/{shard}", {"hash": hashes, "count": _smallest(counts)})
            size, at, share = 0, [0], [0.0]
            for i in range(len(counts)) if counts.sum() > SHARD_TOKENS else ():
                if size + counts[i] > SHARD_TOKENS and size:
                    at.append(i)
                    share.append(0.0)
                    size = 0
                parts = -(-int(counts[i]) // SHARD_TOKENS)
                at += [i] * (parts - 1)
                share += [k / parts for k in range(1, parts)]
                size += int(counts[i]) if parts == 1 else SHARD_TOKENS
            n = len(at)
            yield pa.record_batch([pa.array([shard] * n, pa.int64()), pa.array([len(counts)] * n, pa.int64()), pa.array(at, pa.int64()), pa.array(share, pa.float64())], names=["shard", "size", "at", "share"])

    return run


CODED = "id long, codes binary"


def _codes(trie: Trie):
    """Documents as 32-bit word ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids_, hashes, firsts in blocks(batches, hashed):
            own, place = np.unique(hashes, return_inverse=True)
            codes = trie.words(own)[place].astype("<u4")
            cuts = [*firsts.tolist(), len(codes)]
            yield pa.record_batch([pa.array(ids_, pa.int64()), pa.array([codes[x:y].tobytes() for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=["id", "codes"])

    return run


# Levels 2 and 3 --------------------------------------------------------------------------------------


class Block:
    """The words, pairs and triples of a block of tokens; ``own`` has its words in order, ``at`` the place there of each token."""

    def __init__(self, codes: np.ndarray, firsts: np.ndarray):
        self.own, self.at = np.unique(codes, return_inverse=True)
        self.starts = firsts
        self.first = np.zeros(len(codes), bool)  # tokens without one before, and without two
        self.second = np.zeros(len(codes), bool)
        self.first[firsts] = True
        self.second[1:] = self.first[:-1]
        self.second &= ~self.first
        self.last = np.r_[self.first[1:], True]

    def triples(self) -> tuple[np.ndarray, ...]:
        """Words of the different triples, in order, and their counts; a document's last pair has no third word."""
        a = np.flatnonzero(~self.last)
        third = np.append(self.at + 1, 0)[a + 2] if len(a) else a
        third = np.where(self.last[a + 1], 0, third) if len(a) else a
        x, y = self.at[a], self.at[np.minimum(a + 1, len(self.at) - 1)]
        if len(self.own) + 1 < 1 << LOCAL:
            keys, counts = np.unique((x << 2 * LOCAL) | (y << LOCAL) | third, return_counts=True)
            x, y, z = keys >> 2 * LOCAL, (keys >> LOCAL) & ((1 << LOCAL) - 1), keys & ((1 << LOCAL) - 1)
        else:
            pairs, of = np.unique(_packed(x, y), return_inverse=True)
            keys, counts = np.unique(_packed(of, third), return_counts=True)
            pair, z = pairs[(keys >> np.uint64(32)).astype(np.int64)], (keys & np.uint64(NONE)).astype(np.int64)
            x, y = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(NONE)).astype(np.int64)
        return self.own[x], self.own[y], np.append(np.uint32(NONE), self.own)[z], counts


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, compressed byte plane by byte plane."""
    flat = np.concatenate([c.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel() for c in columns])
    return len(columns[0]).to_bytes(4, "little") + pa.Codec("zstd", 1).compress(flat.tobytes(), asbytes=True)


def _unplaned(data: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    flat = np.frombuffer(pa.Codec("zstd").decompress(data[4:], 4 * n * columns, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(columns, 4, n).transpose(0, 2, 1)).view("<u4").reshape(columns, n)


def _triple_counts(trie: Trie):
    """A row for each shard that a block has triples of: words in order (the first as differences) and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, codes, firsts in blocks(batches, coded):
            x, y, z, n = Block(codes, firsts).triples()
            shard = np.searchsorted(trie.bounds, _packed(x, y), side="right") - 1
            out = [(s, _planes(np.diff(x[h], prepend=np.uint32(0)), y[h], z[h], n[h])) for s, h in _runs(shard)]
            yield pa.record_batch([pa.array([s for s, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["shard", "part"])

    return run


def _write_shards(trie: Trie):
    """Writes levels 2 and 3; gives the mass that words whose pairs lie in several shards keep in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, rows in _by_shard(batches):
            parts = [_unplaned(b.as_py(), 4) for r in rows for b in r.column(1)]
            x = np.concatenate([np.cumsum(p[0], dtype=np.int64) for p in parts])
            y, z, n = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (1, 2, 3))
            low, high = trie.range(s)
            pairs, of = np.unique(_packed(x - low, y), return_inverse=True)
            key = _packed(of, z)
            order = np.argsort(key)
            fresh = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
            count3 = np.add.reduceat(n[order], fresh)
            key = key[order][fresh]
            count2 = np.bincount(of, n, len(pairs))
            own, word2 = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(NONE)).astype(np.int64)
            total = trie.counts(np.arange(low, high)).astype(float)
            share2 = (count2 - DISCOUNT) / total[own]
            kept2 = np.bincount(own, share2, high - low)
            real = (key & np.uint64(NONE)) != NONE
            pair, word3, count3 = (key[real] >> np.uint64(32)).astype(np.int64), (key[real] & np.uint64(NONE)).astype(np.int64), count3[real]
            share3 = (count3 - DISCOUNT) / count2[pair]
            out: dict[str, np.ndarray] = {}
            forms = (*_level(own, word2, high - low), *_level(pair, word3, len(pairs)))
            for kind, form in zip(("pairs", "words2", "triples", "words3"), forms, strict=True):
                out |= {f"{kind}.{k}": v for k, v in form.items()}
            out["p2_levels"], out["p2"] = codebook(np.log10(share2))
            out["p3_levels"], out["p3"] = codebook(np.log10(share3))
            out["back2_levels"], out["back2"] = codebook(np.log10(np.clip(1 - kept2, 1e-9, 1)))
            out["back3_levels"], out["back3"] = codebook(np.log10(np.clip(1 - np.bincount(pair, share3, len(pairs)), 1e-9, 1)))
            save(f"{trie.uri}/2/{s}", out)
            shared = np.flatnonzero(np.isin(np.arange(low, high), trie.split))
            yield pa.record_batch([pa.array(shared + low), pa.array(kept2[shared])], names=["word", "kept"])

    return run


def build(docs: DataFrame, train) -> tuple[Trie, DataFrame]:
    """The trie of the rows of ``docs`` (id, text) where ``train`` (a column of id) holds, and all documents as codes (a written table)."""
    spark = docs.sparkSession
    uri = f"{shared_dir(spark)}/ngrams-{uuid.uuid4().hex}"
    words = materialize(docs.where(train).mapInArrow(_word_counts, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")), "words")
    types, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if types >= NONE:
        raise ValueError(f"{types} different words; 32-bit ids have room for {NONE - 1}")
    bits = max(0, int(np.ceil(np.log2(max(1, types / SHARD_WORDS)))))
    shard = F.shiftrightunsigned("k", 64 - bits) if bits else F.lit(0).cast("long")
    rows = words.select(shard.cast("long").alias("shard"), "k", "n").repartition(F.col("shard")).sortWithinPartitions("shard")
    cuts = sorted(map(tuple, rows.mapInArrow(_write_words(uri), "shard long, size long, at long, share double").collect()))  # a row for each shard
    remove(words)
    sizes = {s: size for s, size, _, _ in cuts}
    first = np.cumsum([0] + [sizes.get(s, 0) for s in range(1 << bits)])
    trie = Trie(uri, bits, first, total)
    begin = [((int(first[s]) + at) << 32) | int(share * types) for s, _, at, share in cuts]
    trie.bounds = np.unique(np.array([0, *begin], np.uint64))
    trie.split = np.unique([int(first[s]) + at for s, _, at, share in cuts if share > 0]).astype(np.int64)
    table = materialize(docs.mapInArrow(_codes(trie), CODED), "codes")
    parts = table.where(train).mapInArrow(_triple_counts(trie), "shard long, part binary").repartition(F.col("shard")).sortWithinPartitions("shard")
    kept = parts.mapInArrow(_write_shards(trie), "word long, kept double").groupBy("word").agg(F.sum("kept")).collect()  # words with more than SHARD_TOKENS tokens
    mass = dict(map(tuple, kept))
    trie.split_back = np.log10(np.clip([1 - mass.get(w, 0.0) for w in trie.split.tolist()], 1e-9, 1))
    return trie, table


# Scores ----------------------------------------------------------------------------------------------


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first ones of different rows (of two columns), in order, and the number of each row."""
    _, at, of = np.unique(_packed(*columns), return_index=True, return_inverse=True)
    return at, of


def score_block(trie: Trie, codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, log10 of the base and log10 of the model's probability of each token."""
    block = Block(codes, firsts)
    own, at = block.own.astype(np.int64), block.at
    known = own != NONE
    counts = trie.counts(own)
    base = np.log10((counts + 1) / (trie.total + trie.types + 1))
    score = base[at]
    # Pairs of which the first word is known.
    here = np.flatnonzero(~block.first & known[np.r_[0, at[:-1]]])
    if len(here):
        backs = np.zeros(len(own))
        backs[known] = trie.backs(own[known])
        one, of = _distinct(at[here - 1], at[here])
        x, y = at[here - 1][one], at[here][one]
        shard, place, p = np.zeros(len(x), np.int64), np.full(len(x), -1, np.int64), np.zeros(len(x))
        both = known[y]
        shard[both], place[both], p[both] = trie.pairs(own[x[both]], own[y[both]])
        value = np.log10(np.where(place >= 0, 10**p, 0.0) + 10 ** (backs[x] + base[y]))
        score[here] = value[of]
        # Triples whose first pair is known.
        pair = np.full(len(codes), -1, np.int64)
        pair[here] = of
        third = np.flatnonzero(~block.first & ~block.second)
        third = third[pair[third - 1] >= 0]
        third = third[place[pair[third - 1]] >= 0]
        if len(third):
            one, of = _distinct(pair[third - 1], at[third])
            x, y = pair[third - 1][one], at[third][one]
            # Unknown words are no child of any pair; their number is that of no word.
            hit, p, back = trie.triples(shard[x], place[x], own[y])
            lower = score[third][one]
            value = np.log10(np.where(hit, 10**p, 0.0) + 10 ** (back + lower))
            score[third] = value[of]
    return counts[at], base[at], score


def scored(table: DataFrame, trie: Trie) -> DataFrame:
    """id, n_tokens, n_known, base_score and score of every row of ``table`` (id, codes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids_, codes, firsts in blocks(batches, coded):
            counts, base, score = score_block(trie, codes, firsts)
            n = np.diff(np.r_[firsts, len(codes)])
            known = np.add.reduceat((counts > 0).astype(np.int64), firsts)
            yield pa.record_batch(
                [pa.array(ids_, pa.int64()), pa.array(n), pa.array(known), pa.array(np.add.reduceat(base, firsts)), pa.array(np.add.reduceat(score, firsts))],
                names=["id", "n_tokens", "n_known", "base_score", "score"],
            )

    return table.mapInArrow(run, "id long, n_tokens long, n_known long, base_score double, score double")


def op7_elias_fano_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base_documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("id"), "text")
    fold = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(7))
    trie, table = build(docs, F.coalesce(fold != 2, F.lit(True)))
    out = scored(table, trie)
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score")
