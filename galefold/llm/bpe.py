"""Byte-level BPE encoding and decoding.

Pre-tokenisation is one finite automaton over classes of code points. A symbol is a character's class
with what its rule must see ahead (the letters of a contraction, whether white space ends). Each symbol
stands for a function from states to states; the functions that symbols can compose are few, so they are
numbered and their compositions tabled. Composing is associative: blocks of the text are composed side by
side, the blocks' functions are combined by doubling steps, and a second sweep from the now known states
marks where pieces begin. No regular expression runs over a text.

Pieces are looked up in a bounded cache; those of a batch that it lacks are merged together, one merge a
piece and round: the lowest rank first, and the leftmost of equals. Pieces over 64 bytes merge by a heap
over a linked list, so time stays near-linear.

The classes of code points are those of the library whose results count (its regular-expression engine
knows newer Unicode than Python does); the driver asks it once and broadcasts the 1.1 MB table.

Edge cases: a null or empty text has no ids and decodes to no bytes. Texts over a million characters
pass in pieces with the automaton's state handed on. Unknown ids raise. Extra columns stay unread.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galefold.llm.chars import BLOCK, GROUP, points
from galefold.llm.shared import release, runs, text_slices, type_of

# The white space of Unicode, and the contractions of the pre-tokenisation rules.
WHITE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SHORT_ENDS = "stmd"
LONG_ENDS = ("re", "ve", "ll")

# Classes of code points.
OTHER, LETTER, NUMBER, BLANK, SPACE, QUOTE = range(6)
# Symbols: letter, number, other, quotes that may begin a contraction of one or two letters, a space that
# joins what follows, the last of a run of white space before something else, other white space.
S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2, S_JOIN, S_LAST, S_WHITE = range(8)
FIRST = 8  # added to the symbol of a text's first character
IDLE = 16  # leaves every state as it is
# States: what the piece so far is; DONE also stands for no piece yet.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINING, IN_WHITE, ONE_LEFT, TWO_LEFT, DONE = range(8)
NEVER = (1 << 31) - 1  # the rank of parts that don't merge


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece begins, by symbol and state."""
    to, begins = np.zeros((17, 8), np.uint8), np.zeros((17, 8), bool)
    runs_of = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS, S_WHITE: IN_WHITE}
    for state in range(8):
        for symbol, run in runs_of.items():
            goes_on = state == run or (state == JOINING and symbol != S_WHITE)
            to[symbol, state], begins[symbol, state] = run, not goes_on
        if state in (ONE_LEFT, TWO_LEFT):  # the look-ahead made sure that these letters follow
            to[S_LETTER, state], begins[S_LETTER, state] = (DONE if state == ONE_LEFT else ONE_LEFT), False
        for symbol, then in ((S_QUOTE1, ONE_LEFT), (S_QUOTE2, TWO_LEFT)):
            goes_on = state in (IN_OTHERS, JOINING)
            to[symbol, state], begins[symbol, state] = (IN_OTHERS if goes_on else then), not goes_on
        to[S_JOIN, state], begins[S_JOIN, state] = JOINING, True
        to[S_LAST, state], begins[S_LAST, state] = IN_WHITE, True
        to[IDLE, state] = state
    to[FIRST:IDLE], begins[FIRST:IDLE] = to[:FIRST, [DONE]], True
    return to, begins


def _functions(to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that symbols compose, as rows of states; the function after one more symbol; after another function."""
    known: dict[tuple[int, ...], int] = {tuple(range(8)): 0}
    rows, steps = list(known), []
    for row in rows:  # grows meanwhile
        then = []
        for symbol in to:
            new = tuple(int(symbol[x]) for x in row)
            if new not in known:
                known[new] = len(known)
                rows.append(new)
            then.append(known[new])
        steps.append(then)
    table = np.array(rows)
    return table, np.array(steps), np.array([[known[tuple(b[x] for x in a)] for b in rows] for a in rows])


TO, BEGINS = _automaton()
FUNCTIONS, STEP, COMPOSED = _functions(TO)
TO, BEGINS, STEP = TO.ravel().astype(np.intp), BEGINS.ravel(), STEP.ravel().astype(np.intp)


def class_table() -> np.ndarray:
    """Class of each code point, as the tokenizer library's engine sees letters and numbers."""
    import tiktoken

    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    table = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        asked = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        table[points([asked.decode_bytes(asked.encode_ordinary(every)).decode()])] = kind
    table[list(WHITE)] = BLANK
    table[0x20], table[0x27] = SPACE, QUOTE
    return table


def symbols(codes: np.ndarray, ahead: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A symbol for each code point; ``ahead``: up to two code points that follow; ``first``: where texts begin."""
    n = len(codes)
    full = np.concatenate([codes, ahead, np.full(2 - len(ahead), 0xFFFFFFFF, np.uint32)])
    kinds = np.append(classes[full[: n + len(ahead)]], np.full(2 - len(ahead), 255, np.uint8))
    one, two, next_kind = full[1 : n + 1].copy(), full[2 : n + 2].copy(), kinds[1 : n + 1].copy()
    ends = first[first > 0] - 1  # nothing follows the last character of a text
    one[ends], next_kind[ends] = 0xFFFFFFFF, 255
    two[ends] = 0xFFFFFFFF
    two[ends[ends > 0] - 1] = 0xFFFFFFFF
    kind = kinds[:n]
    out = np.array([S_OTHER, S_LETTER, S_NUMBER, S_WHITE, S_WHITE, S_OTHER], np.uint8)[kind]
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        a, b = one[quotes], two[quotes]
        out[quotes[np.isin(a, points([SHORT_ENDS]))]] = S_QUOTE1
        for x, y in LONG_ENDS:
            out[quotes[(a == ord(x)) & (b == ord(y))]] = S_QUOTE2
    stops = (next_kind != BLANK) & (next_kind != SPACE) & (next_kind != 255)
    out[(kind == SPACE) & stops] = S_JOIN
    out[(kind == BLANK) & stops] = S_LAST
    out[first] += FIRST
    return out


def scanned(marks: np.ndarray, state: int = DONE, width: int = 128) -> tuple[np.ndarray, int]:
    """Where pieces begin in a row of symbols, and the state after it."""
    rows = -(-len(marks) // width) or 1
    grid = np.full(rows * width, IDLE, np.uint8)
    grid[: len(marks)] = marks
    grid = np.ascontiguousarray(grid.reshape(rows, width).T).astype(np.intp)
    function = np.zeros(rows, np.intp)
    for column in grid:
        function = STEP[function * 17 + column]
    step = 1
    while step < rows:  # after each round a row has the composition of twice as many blocks
        function[step:] = COMPOSED[function[:-step], function[step:]]
        step *= 2
    states = np.empty(rows, np.intp)
    states[0], states[1:] = state, FUNCTIONS[function[:-1], state]
    found = np.empty((width, rows), bool)
    for i, column in enumerate(grid):
        at = column * 8 + states
        found[i], states = BEGINS[at], TO[at]
    return np.flatnonzero(found.T.ravel()[: len(marks)]), int(FUNCTIONS[function[-1], state])


class Vocabulary:
    """Ranks of byte strings, with the cache of merged pieces."""

    def __init__(self, file: bytes, classes: np.ndarray, cached: int = 1 << 17, cached_bytes: int = 16 << 20):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines()) if a}
        self.classes, self.most, self.most_bytes = classes, cached, cached_bytes
        strings = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for s, i in self.ranks.items():
            strings[i] = s
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        # Every way to put a string of the vocabulary together from two others.
        ranks = self.ranks
        found = ((x << 32 | y, i) for s, i in ranks.items() for k in range(1, len(s)) if (x := ranks.get(s[:k])) is not None and (y := ranks.get(s[k:])) is not None)
        halves = np.fromiter((v for both in found for v in both), np.int64).reshape(-1, 2)
        halves = halves[np.argsort(halves[:, 0], kind="stable")]
        self.pair_keys, self.pair_ranks = np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.held = 0  # bytes of the pieces in it
        self.flat, self.counts, self.firsts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[i] = np.array([rank], np.int32)
            elif len(piece) > 64:
                out[i] = np.array(self._merge_long(piece), np.int32)
            else:
                short.append(i)
        for k in range(0, len(short), 1 << 15):
            part = short[k : k + (1 << 15)]
            for i, ids in zip(part, self._merge_many([pieces[i] for i in part]), strict=True):
                out[i] = ids
        return out

    def _merge_many(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Parts are the positions where they begin, with links to both sides; the end of a piece links to a spare last place."""
        lengths = np.array([len(p) for p in pieces])
        firsts = np.cumsum(lengths) - lengths
        n = int(lengths.sum())
        ids = np.append(self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[firsts + lengths - 1], before[firsts] = n, n
        after[n] = before[n] = n
        places = np.arange(n + 1)
        best = self._rank(ids, ids[after]) << 32 | places  # rank, then place
        alive = np.ones(n + 1, bool)
        while True:
            least = np.minimum.reduceat(best[:n], firsts)
            at = least[least >> 32 != NEVER] & 0xFFFFFFFF
            if not len(at):
                break
            gone = after[at]
            ids[at] = best[at] >> 32
            alive[gone], best[gone] = False, NEVER << 32
            after[at] = after[gone]
            before[after[at]] = at
            best[at] = self._rank(ids[at], ids[after[at]]) << 32 | at
            left = before[at]
            best[left] = self._rank(ids[left], ids[at]) << 32 | left
            ids[n], best[n] = -1, NEVER << 32
        alive[n] = False
        held = np.add.reduceat(alive[:n].astype(np.int64), firsts)
        return np.split(ids[:n][alive[:n]].astype(np.int32), np.cumsum(held)[:-1])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at i
        alive = bytearray(b"\1") * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != mid or mid >= n or not alive[mid] or end[mid] != stop:
                continue
            alive[mid], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, stop, end[stop]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, i, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and the number of ids of each piece."""
        rows = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            new = list(dict.fromkeys(pieces[i] for i in missing.tolist()))
            size = sum(map(len, new))
            if self.index and (len(self.index) + len(new) > self.most or self.held + size > self.most_bytes):
                self._forget()
                return self._ids(pieces)
            self.held += size
            merged = self.merge(new)
            counts = np.array([len(x) for x in merged], np.int64)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.firsts = np.concatenate([self.firsts, len(self.flat) + np.cumsum(counts) - counts])
            self.flat, self.counts = np.concatenate([self.flat, *merged]), np.concatenate([self.counts, counts])
            rows[missing] = [self.index[pieces[i]] for i in missing.tolist()]
        counts = self.counts[rows]
        upto = np.cumsum(counts)
        where = np.repeat(self.firsts[rows] - upto + counts, counts) + np.arange(int(counts.sum()))
        return self.flat[where], counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        ids, counts = [], np.zeros(len(texts), np.int64)
        for lo, hi in runs([len(t) for t in texts], GROUP):
            if hi - lo == 1 and len(texts[lo]) > BLOCK:
                for pieces in self._long_pieces(texts[lo]):
                    found, _ = self._ids(pieces)
                    ids.append(found)
                    counts[lo] += len(found)
                continue
            codes = points(texts[lo:hi])
            lengths = np.array([len(t) for t in texts[lo:hi]])
            starts = np.cumsum(lengths) - lengths
            cuts, _ = scanned(symbols(codes, np.empty(0, np.uint32), starts[lengths > 0], self.classes))
            found, sizes = self._ids(split("".join(texts[lo:hi]).encode("utf-8", "surrogatepass"), len(codes), cuts))
            ids.append(found)
            upto = np.append(0, np.cumsum(sizes))
            counts[lo:hi] = np.diff(upto[np.searchsorted(cuts, np.append(starts, len(codes)))])
        return np.concatenate(ids) if ids else np.empty(0, np.int32), counts

    def _long_pieces(self, text: str) -> Iterator[list[bytes]]:
        state, begin = DONE, 0
        for at in range(0, len(text), BLOCK):
            codes, ahead = points([text[at : at + BLOCK]]), points([text[at + BLOCK : at + BLOCK + 2]])
            first = np.zeros(1 if at == 0 else 0, np.int64)
            cuts, state = scanned(symbols(codes, ahead, first, self.classes), state)
            cuts = [begin, *(c for c in (cuts + at).tolist() if c > begin)]
            yield [text[a:b].encode("utf-8", "surrogatepass") for a, b in pairwise(cuts)]
            begin = cuts[-1]
        yield [text[begin:].encode("utf-8", "surrogatepass")]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and the byte at which each id's begin."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            raise ValueError("an id isn't in the vocabulary")
        lengths = self.lengths[ids]
        starts = np.cumsum(lengths) - lengths
        where = np.repeat(self.begins[ids] - starts, lengths) + np.arange(lengths.sum())
        return self.bytes[where], starts


def split(data: bytes, n: int, cuts: np.ndarray) -> list[bytes]:
    """UTF-8 of the pieces of ``n`` characters that begin at ``cuts``; they are parted by a byte that UTF-8 never has."""
    if not len(cuts):
        return []
    whole = np.frombuffer(data, np.uint8)
    if len(data) > n:
        cuts = np.flatnonzero((whole & 0xC0) != 0x80)[cuts]
    return np.insert(whole, cuts[1:], 0xFF).tobytes().split(b"\xff")


@cache
def _loaded(file: bytes, classes: bytes) -> Vocabulary:
    found = Vocabulary(file, np.frombuffer(classes, np.uint8))
    release()
    return found


def _shipped(frame: DataFrame, path: str) -> Broadcast:
    """The vocabulary file and the class table; both are of fixed size."""
    with open(path, "rb") as f:
        file = f.read()
    return frame.sparkSession.sparkContext.broadcast((file, class_table().tobytes()))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values))


def _encoded(vocabulary: Vocabulary, batch: pa.RecordBatch, decode: bool) -> Iterator[pa.RecordBatch]:
    for lo, texts in text_slices(batch.column(batch.num_columns - 1), BLOCK):
        hi = lo + len(texts)
        ids, counts = vocabulary.encode([x or "" for x in texts])
        after = np.append(0, np.cumsum(vocabulary.lengths[ids]))
        starts, byte_at = after[:-1], after[np.append(0, np.cumsum(counts))]
        offsets = (starts - np.repeat(byte_at[:-1], counts)).astype(np.int32)
        columns = [*batch.slice(lo, hi - lo).columns[:-1], _lists(ids, counts), _lists(offsets, counts)]
        names = [*batch.schema.names[:-1], "ids", "starts"]
        if decode:
            data, _ = vocabulary.decode(ids)
            columns.append(pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(byte_at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]))
            names.append("decoded")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), decode: bool = False) -> DataFrame:
    """``keep`` with ids array<int> and starts array<int>, the byte of the text at which each id's bytes begin.

    ``path``: a file of base64 byte strings and ranks. ``decode`` adds decoded binary, read back from the ids.
    """
    shipped = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what the worker's earlier stages left
        vocabulary = _loaded(*shipped.value)
        for batch in batches:
            yield from _encoded(vocabulary, batch, decode)

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias("__gf_text"))
    kinds = ", ".join(f"`{c}` {type_of(docs, c)}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, ids array<int>, starts array<int>" + ", decoded binary" * decode)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with decoded binary: the bytes of each row's ids."""
    shipped = _shipped(tokens, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(*shipped.value)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            data, starts = vocabulary.decode(lists.flatten().to_numpy(zero_copy_only=False))
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            byte_at = np.append(starts, len(data))[np.append(0, np.cumsum(counts))]
            parts = [data[a:b].tobytes() for a, b in pairwise(byte_at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(parts, pa.binary())], names=[*batch.schema.names[:-1], "decoded"])

    rows = tokens.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("__gf_ids"))
    kinds = ", ".join(f"`{c}` {type_of(tokens, c)}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, decoded binary")
