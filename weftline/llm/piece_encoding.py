"""SentencePiece encoding and decoding by suffix-array matching.

Per Arrow batch the distinct new words are laid end to end and indexed by a suffix array, sorted by doubling; every piece
of the vocabulary is binary-searched, whole, for its range of occurrences; the occurrences are edges over positions, sorted by where they end,
then relaxed in that order. For a BPE model the edge that ends a prefix's encoding is the one whose piece may follow the
piece before it, i.e. whose pair BPE would leave as it is; there is exactly one. So relaxing gives the library's own
pieces, without merging. Words are runs up to the next space, over which no piece reaches. Nothing is shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import small_batches

MARK = "▁"
MEMO_WORDS = 600_000
#: The pair table's slots; a slot keeps the pair that came last.
PAIRS_LOG2 = 21
#: New words that are indexed together, in bytes.
TEXT_BYTES = 2_000_000
_NONE, _START = -2, -1


def merge(symbols: list[bytes], rank: dict[bytes, int]) -> list[bytes]:
    """Plain BPE: merge the best-ranked neighbouring pair, leftmost first, while any pair is a piece. n log n steps."""
    symbols = list(symbols)
    n = len(symbols)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    queue = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank.get(symbols[i] + symbols[i + 1])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, one, other = heapq.heappop(queue)
        j = after[i]
        # Either side has changed since, or went into another symbol (empty then).
        if j < 0 or symbols[i] != one or symbols[j] != other:
            continue
        symbols[i], symbols[j], after[i] = one + other, b"", after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (r := rank.get(symbols[left] + symbols[right])) is not None:
                heapq.heappush(queue, (r, left, symbols[left], symbols[right]))
    return [x for x in symbols if x]


def suffix_array(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the order of what follows them, 8-byte keys by position). data: words, each closed by a zero byte.

    The order is full up to each word's end: positions that agree so far are sorted by the rank of what comes after,
    8, 16, 32 ... bytes on, until no open ones agree.
    """
    n = len(data)
    padded = np.frombuffer(data + bytes(16), np.uint8)
    keys = np.zeros(n + 8, np.uint64)
    for i in range(8):
        keys[:n] = (keys[:n] << np.uint64(8)) | padded[i : n + i]
    order = np.argsort(keys[:n])
    ordered = keys[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    new = np.flatnonzero(fresh)
    size = np.diff(new, append=n)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(new, size)
    ends = np.flatnonzero(padded[:n] == 0)
    left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n)
    width = 8
    places = np.flatnonzero(np.repeat(size > 1, size))
    while True:
        at = order[places]
        open_ = left[at] >= width
        places, at = places[open_], at[open_]
        if not len(at):
            return order, keys
        # A group is open as a whole: its members agree on all bytes so far. Places ascend with rank.
        both = rank[at] * n + rank[at + width]
        sorted_ = np.argsort(both)
        at, both = at[sorted_], both[sorted_]
        order[places] = at
        first = np.ones(len(at), bool)
        first[1:] = both[1:] != both[:-1]
        size = np.diff(np.flatnonzero(first), append=len(at))
        rank[at] = np.repeat(places[first], size)
        places = places[np.repeat(size > 1, size)]
        width *= 2


class PieceModel:
    """A SentencePiece BPE model with byte fallback. Pieces are numbered by rank: single characters, then merges in order."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        names = {i: model.id_to_piece(i) for i in plain}
        single = sorted(i for i in plain if len(names[i]) == 1)
        joined = sorted((i for i in plain if len(names[i]) > 1), key=lambda i: (-model.get_score(i), i))
        self.ids = np.array([*single, *joined], np.int64)
        text = [names[i].replace(MARK, " ").encode() for i in self.ids.tolist()]
        self.rank = {t: r for r, t in enumerate(text) if r >= len(single)}
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.singles = {t: r for r, t in enumerate(text[: len(single)])}
        self.bytes_of = {i: names[i].replace(MARK, " ").encode() for i in plain} | {i: bytes([b]) for b, i in self.byte_id.items()}
        n = len(text)
        self.unknown = n
        self.left, self.right = np.arange(n + 1), np.arange(n + 1)
        every = self.singles | self.rank
        pairs, reached = [], np.ones(n, bool)
        for r in range(len(single), n):
            chars = [c.encode() for c in text[r].decode()]
            halves = merge(chars, {k: v for k in _parts(text[r], chars) if (v := self.rank.get(k, n)) < r})
            reached[r] = len(halves) == 2 and all(h in every for h in halves)
            if reached[r]:
                self.left[r], self.right[r] = (every[h] for h in halves)
                pairs.append((self.left[r] * (n + 1) + self.right[r], r))
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = table[:, 0].copy(), table[:, 1].copy()
        # What is binary-searched: each piece's bytes, by eight, as ranges of numbers.
        usable = [r for r in range(n) if reached[r]]
        self.found = np.array(usable)
        self.lengths = np.array([len(text[r]) for r in usable])
        self.blocks = []
        for at in range(0, int(self.lengths.max()), 8):
            these = np.flatnonzero(self.lengths > at)
            parts = [text[usable[i]][at : at + 8] for i in these]
            low, high = ([int.from_bytes(p.ljust(8, fill)) for p in parts] for fill in (b"\0", b"\xff"))
            self.blocks.append((at, these, np.array(low, np.uint64), np.array(high, np.uint64)))
        self.seen_pairs = np.full(1 << PAIRS_LOG2, -1, np.int64)
        self.seen_fits = np.zeros(1 << PAIRS_LOG2, bool)
        self.memo: dict[bytes, bytes] = {}

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a and b merge into; beyond all ranks if none."""
        keys = a * (self.unknown + 1) + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], 1 << 60)

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Would BPE leave pieces a and b side by side? Their merges are undone, later one first, and checked across."""
        fits = np.ones(len(a), bool)
        live = np.flatnonzero((a != self.unknown) & (b != self.unknown))
        a, b, limit = a[live], b[live], np.full(len(live), 1 << 60)
        while len(live):
            broken = self._pair(a, b) < limit
            fits[live[broken]] = False
            first = a > b
            # Undo a's merge where it is the later one, or where b is a single character; likewise b's.
            undo_a = np.where(first, self.right[a] != a, self.left[b] == b)
            ended = (self.right[a] == a) & (self.left[b] == b)
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            keep = ~(broken | ended)
            live, a, b, limit = live[keep], a[keep], b[keep], limit[keep]
        return fits

    def follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * (self.unknown + 1) + b
        at = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIRS_LOG2)).astype(np.int64)
        fits = self.seen_fits[at]
        new = np.flatnonzero(self.seen_pairs[at] != keys)
        if len(new):
            pairs, back = np.unique(keys[new], return_inverse=True)
            got = self._follow(pairs // (self.unknown + 1), pairs % (self.unknown + 1))
            fits[new] = got[back]
            place = ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIRS_LOG2)).astype(np.int64)
            self.seen_pairs[place] = pairs
            # Where two new pairs share a slot the last one has both arrays.
            self.seen_fits[place] = got
        return fits

    def edges(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, rank) of every occurrence of every piece in data: each piece's range of the suffix array."""
        suffixes, keys = suffix_array(data)
        low, high = np.zeros(len(self.lengths), np.int64), np.full(len(self.lengths), len(suffixes))
        for at, these, least, most in self.blocks:
            # In the range of what a piece has before this block, suffixes are in the order of what they have here.
            lo, hi = low[these], high[these]
            low[these], high[these] = _first(keys, suffixes, at, lo, hi, least, False), _first(keys, suffixes, at, lo, hi, most, True)
        counts = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(len(counts)), counts)
        start = suffixes[np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)]
        return start, self.lengths[piece], self.found[piece]

    def _plain(self, word: bytes) -> bytes:
        """Encoding by merging: for runs of spaces, whose pieces share one rank, and words with a zero byte."""
        out = []
        for part in merge([c.encode("utf-8", "surrogatepass") for c in word.decode("utf-8", "surrogatepass")], self.rank):
            r = self.rank.get(part, self.singles.get(part))
            out += [int(self.ids[r])] if r is not None else [self.byte_id[b] for b in part]
        return np.array(out, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Encode new words, each a space and what follows it up to the next, into the memo."""
        data = b"\0".join(words) + b"\0"
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        end = begin + lengths
        start, size, rank = self.edges(data)
        # Characters that are no piece: one edge each, to be spelled in bytes.
        raw = np.frombuffer(data, np.uint8)
        heads = np.flatnonzero(((raw & 0xC0) != 0x80) & (raw != 0))
        known = np.zeros(len(raw) + 1, bool)
        known[start[rank < len(self.singles)]] = True
        odd = heads[~known[heads]]
        if len(odd):
            width = np.where(raw[odd] < 0x80, 1, np.where(raw[odd] < 0xE0, 2, np.where(raw[odd] < 0xF0, 3, 4)))
            start, size, rank = np.concatenate((start, odd)), np.concatenate((size, width)), np.concatenate((rank, np.full(len(odd), self.unknown)))
        owner = np.repeat(np.arange(len(words)), lengths + 1)
        local = start + size - begin[owner[start]]
        order = np.argsort(local.astype(np.uint16 if lengths.max() < 65536 else np.int64), kind="stable")
        start, size, rank, local = start[order], size[order], rank[order], local[order]
        last = np.full(len(raw) + 1, _NONE, np.int64)
        came = np.zeros(len(raw) + 1, np.int64)
        last[begin] = _START
        cuts = np.flatnonzero(np.diff(local, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(local)], strict=True):
            s, r = start[lo:hi], rank[lo:hi]
            before = last[s]
            fits = before == _START
            ask = np.flatnonzero(before >= 0)
            fits[ask] = self.follow(before[ask], r[ask])
            to = s[fits] + size[lo:hi][fits]
            last[to], came[to] = r[fits], s[fits]
        live, at, rounds = np.arange(len(words)), end, []
        while len(live):
            rounds.append((live, last[at], at))
            at = came[at]
            go = at > begin[live]
            live, at = live[go], at[go]
        who = np.concatenate([r[0] for r in rounds])
        ranks = np.concatenate([r[1] for r in rounds])
        step = np.repeat(np.arange(len(rounds)), [len(r[0]) for r in rounds])
        n = np.bincount(who, minlength=len(words))
        stop = np.cumsum(n)
        put = np.empty(len(who), np.int64)
        put[stop[who] - 1 - step] = ranks
        ids = np.append(self.ids, -1)[put].astype("<u4").tobytes()
        spelled = set(who[ranks == self.unknown].tolist())
        for i, (word, a, b) in enumerate(zip(words, (stop - n).tolist(), stop.tolist(), strict=True)):
            self.memo[word] = self._spelled(word, put[a:b]) if i in spelled else ids[4 * a : 4 * b]

    def _spelled(self, word: bytes, ranks: np.ndarray) -> bytes:
        out, at = [], 0
        for r in ranks.tolist():
            if r == self.unknown:
                width = 1 if word[at] < 0x80 else 2 if word[at] < 0xE0 else 3 if word[at] < 0xF0 else 4
                out += [self.byte_id[b] for b in word[at : at + width]]
            else:
                width = len(self.bytes_of[int(self.ids[r])])
                out.append(int(self.ids[r]))
            at += width
        return np.array(out, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32 bit) of each text; a text's first word gets a space in front."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        split = []
        for text in texts:
            words = (text or "").replace(MARK, " ").encode("utf-8", "surrogatepass").split(b" ") if text else []
            out, spaces = [], 1
            for w in words:
                if w:
                    out.append(b" " * spaces + w)
                    spaces = 1
                else:
                    spaces += 1
            if words and spaces > 1:
                out.append(b" " * (spaces - 1))
            split.append(out)
        new = set().union(*split).difference(self.memo)
        odd = [w for w in new if w[:2] == b"  " or b"\0" in w]
        for w in odd:
            self.memo[w] = self._plain(w)
        part, size = [], 0
        for w in new.difference(odd):
            part.append(w)
            size += len(w)
            if size > TEXT_BYTES:
                self.learn(part)
                part, size = [], 0
        if part:
            self.learn(part)
        return [b"".join(map(self.memo.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """Text of the ids; the space that encoding put in front goes."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:].decode("utf-8", "replace")


def _first(keys: np.ndarray, suffixes: np.ndarray, at: int, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray, above: bool) -> np.ndarray:
    """Binary search, all at once: the first place of each range whose bytes at places on are wanted or more (above: more)."""
    lo, hi = lo.copy(), hi.copy()
    while len(live := np.flatnonzero(lo < hi)):
        mid = (lo[live] + hi[live]) // 2
        found = keys[np.minimum(suffixes[mid] + at, len(keys) - 1)]
        less = found <= wanted[live] if above else found < wanted[live]
        lo[live[less]] = mid[less] + 1
        hi[live[~less]] = mid[~less]
    return lo


def _parts(text: bytes, chars: list[bytes]) -> Iterator[bytes]:
    for i in range(len(chars)):
        for j in range(i + 2, len(chars) + 1):
            yield b"".join(chars[i:j])


_MODELS: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(texts: Column, path: str) -> Column:
    """Piece ids of each text, binary, little-endian unsigned 32 bit. Null and empty texts have none."""

    @F.pandas_udf("binary")
    def encoded(batch: pd.Series) -> pd.Series:
        return pd.Series(_model(path).encode(batch.tolist()))

    return encoded(texts)


def decode(ids: Column, path: str) -> Column:
    """Texts of the ids; the exact texts that were encoded, but for U+2581, which comes back as a space."""

    @F.pandas_udf("string")
    def decoded(batch: pd.Series) -> pd.Series:
        return pd.Series([_model(path).decode(b) for b in batch])

    return decoded(ids)


def piece_encoding(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_pieces (long), ids (binary), round_trip (decodes to the text itself).

    Null texts count as empty. Repeated rows come back as often as they came in; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), raw.alias("_text"), encode(raw, path).alias("ids"))
    same = decode(F.col("ids"), path) == F.replace("_text", F.lit(MARK), F.lit(" "))
    return rows.select("doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), "ids", same.alias("round_trip"))
