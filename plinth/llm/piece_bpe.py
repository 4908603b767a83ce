"""Encoding and decoding with a SentencePiece BPE model, by vectorised merge rounds.

The symbols of all words of a batch lie in one flat numpy array.  A round finds each word's best pair (segmented
minimum of pair ranks), merges all its leftmost occurrences at once, and compacts the array; it ends when no pair
remains.  Words that were met before come from a bounded table.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from .common import spread

META = "▁"
#: Text bytes and ids handled at once, words kept in the table of a worker, and rounds before a word is finished alone.
SLICE_BYTES, SLICE_IDS, TABLE_WORDS, ROUNDS = 1 << 20, 1 << 18, 250_000, 400
_NONE = np.int64(1) << 40


class PieceModel:
    """The vocabulary of a .model file as arrays: pair ranks, characters, bytes of each piece."""

    def __init__(self, proto: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(size)]
        normal = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(re.search(f"[^{META}]{META}", p) for p in normal):
            raise ValueError("a piece has white space inside: words cannot be encoded apart")
        self.size, self.byte_id = size, {}
        for i in range(size):
            if sp.is_byte(i):
                self.byte_id[int(pieces[i][3:-1], 16)] = i
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        # characters that occur in pieces but are none themselves get ids after the vocabulary
        self.chars = {p: i for p, i in normal.items() if len(p) == 1}
        for p in normal:
            for c in p:
                self.chars.setdefault(c, len(self.chars) + size)
        self.base = max([size, *(i + 1 for i in self.chars.values())])
        symbol = normal | {c: i for c, i in self.chars.items()}
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in normal.values()}, reverse=True))}
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = (order[sp.get_score(i)], i)
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_keys = keys
        self.pair_rank = np.array([pairs[k][0] for k in keys.tolist()], dtype=np.int64)
        self.pair_new = np.array([pairs[k][1] for k in keys.tolist()], dtype=np.int64)
        self._hash_pairs()
        # a piece is loose if a pair that holds it is at least as good as the pair that makes it: then order matters
        rank_of = {i: order[sp.get_score(i)] for i in normal.values()}
        self.loose = np.zeros(self.base, dtype=bool)
        for k, (rank, _) in pairs.items():
            for part in divmod(k, self.base):
                if part in rank_of and rank <= rank_of[part]:
                    self.loose[part] = True
        self.lookup = {k: v for k, v in pairs.items()}
        self.run_ids = {len(p): i for p, i in normal.items() if set(p) == {META}}
        worst = max(order.values())
        self.runs_last = all(rank_of[i] == worst for i in self.run_ids.values()) and all(rank_of[i] < worst for p, i in normal.items() if set(p) != {META})
        self.code = np.full(0x110000, -1, dtype=np.int64)
        for c, i in self.chars.items():
            self.code[ord(c)] = i
        text = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else p.replace(META, " ").encode() for i, p in enumerate(pieces)]
        self.piece_len = np.array([len(t) for t in text], dtype=np.int64)
        self.piece_start = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(text), dtype=np.uint8)

    def _hash_pairs(self) -> None:
        """Pair keys in hash tables, each with what collided in the one before."""
        self.levels, left = [], np.arange(len(self.pair_keys))
        multiplier = 0x9E3779B97F4A7C15
        while len(left):
            bits = max(8, (4 * len(left)).bit_length())
            slot = (self.pair_keys[left].astype(np.uint64) * np.uint64(multiplier) >> np.uint64(64 - bits)).astype(np.int64)
            at, key = np.zeros(1 << bits, dtype=np.int32), np.full(1 << bits, -2, dtype=np.int64)
            at[slot], key[slot] = left, self.pair_keys[left]
            self.levels.append((np.uint64(multiplier), np.uint64(64 - bits), at, key))
            left = left[key[slot] != self.pair_keys[left]]
            multiplier = multiplier * 0xD1B54A32D192ED03 % (1 << 64) | 1

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (_NONE: no such piece) and its index in the pair table."""
        key = np.where((left < self.base) & (right < self.base), left * self.base + right, -1)
        at, found = np.zeros(len(key), dtype=np.int64), np.zeros(len(key), dtype=bool)
        for multiplier, shift, table, keys in self.levels:
            slot = (key.astype(np.uint64) * multiplier >> shift).astype(np.int64)
            hit = keys[slot] == key
            at[hit] = table[slot[hit]]
            found |= hit
        return np.where(found, self.pair_rank[at], _NONE), at

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each word."""
        text = "".join(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        symbols = self.code[points]
        symbols = np.where(symbols < 0, self.base + points, symbols)
        word = np.repeat(np.arange(len(words)), sizes)
        done_word, done_symbol, done_pos = [], [], []
        pos = np.arange(len(symbols))
        if len(symbols):
            # rank and at belong to a symbol and the next one; a word's last symbol has none
            rank, at = self.ranks(symbols, np.r_[symbols[1:], -1])
            rank[np.r_[word[1:] != word[:-1], True]] = _NONE
        loose_word = np.zeros(len(words), dtype=bool)
        for _ in range(ROUNDS):
            if not len(symbols):
                break
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[first, len(symbols)])
            best = np.minimum.reduceat(rank, first)
            live = np.repeat(best < _NONE, counts)
            if not live.all():
                ended = ~live
                done_word.append(word[ended]), done_symbol.append(symbols[ended]), done_pos.append(pos[ended])
                best = np.repeat(best, counts)[live]
                symbols, word, pos, rank, at = symbols[live], word[live], pos[live], rank[live], at[live]
                if not len(symbols):
                    break
            else:
                best = np.repeat(best, counts)
            hit = np.flatnonzero(rank == best)
            # of touching occurrences every second one, from the left; of a loose piece only the word's first
            step = np.arange(len(hit))
            new_run = np.r_[True, np.diff(hit) != 1]
            offset = step - np.maximum.accumulate(np.where(new_run, step, 0))
            loose = self.loose[self.pair_new[at[hit]]]
            if loose.any():
                loose_word[:] = False
                loose_word[word[hit[loose]]] = True
                new_word = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
                hit = hit[np.where(loose_word[word[hit]], new_word, offset % 2 == 0)]
            else:
                hit = hit[offset % 2 == 0]
            symbols[hit] = self.pair_new[at[hit]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            changed = np.zeros(len(symbols), dtype=bool)
            changed[hit] = True
            symbols, word, pos, rank, at, changed = symbols[keep], word[keep], pos[keep], rank[keep], at[keep], changed[keep]
            now = np.flatnonzero(changed)
            redo = np.unique(np.r_[now, now[now > 0] - 1])
            after = np.minimum(redo + 1, len(symbols) - 1)
            new_rank, at[redo] = self.ranks(symbols[redo], symbols[after])
            new_rank[(word[redo] != word[after]) | (after == redo)] = _NONE
            rank[redo] = new_rank
        if len(symbols):  # very long words whose merges depend on each other
            edges = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            for a, b in zip(edges, np.r_[edges[1:], len(symbols)], strict=True):
                left = self._finish(symbols[a:b].tolist())
                done_word.append(np.full(len(left), word[a])), done_symbol.append(np.array(left, dtype=np.int64)), done_pos.append(pos[a] + np.arange(len(left)))
        word, symbols, pos = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (done_word, done_symbol, done_pos))
        order = np.argsort(pos, kind="stable")
        return self._fallback(symbols[order], word[order], len(words))

    def _finish(self, symbols: list[int]) -> list[int]:
        """One word by a heap of (rank, place): the same order of merges, one at a time."""
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        found = lambda a, b: self.lookup.get(symbols[a] * self.base + symbols[b]) if symbols[a] < self.base and symbols[b] < self.base else None
        heap = [(p[0], i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (p := found(i, i + 1))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i] = self.lookup[a * self.base + b][1]
            alive[j], after[i] = False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := found(x, y)):
                    heapq.heappush(heap, (p[0], x, symbols[x], symbols[y]))
        return [s for s, ok in zip(symbols, alive, strict=True) if ok]

    def _fallback(self, symbols: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary become the ids of their UTF-8 bytes."""
        odd = np.flatnonzero(symbols >= self.size)
        if len(odd):
            back = {i: ord(c) for c, i in self.chars.items() if i >= self.size}
            raw = [chr(back.get(s, s - self.base)).encode("utf-8", "surrogatepass") for s in symbols[odd].tolist()]
            count = np.ones(len(symbols), dtype=np.int64)
            count[odd] = [len(r) for r in raw]
            out = np.repeat(symbols, count)
            out[spread((np.cumsum(count) - count)[odd], count[odd])] = [self.byte_id[b] for b in b"".join(raw)]
            symbols, word = out, np.repeat(word, count)
        return symbols.astype(np.int32), np.bincount(word, minlength=n)

    def run(self, length: int) -> list[int]:
        """White space alone: merged from the left, so the longest run piece again and again, then what fits."""
        ids, sizes = [], sorted(self.run_ids, reverse=True)
        for size in sizes:
            ids += [self.run_ids[size]] * (length // size)
            length %= size
        return ids

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Text of each run of ids: pieces joined, bytes as UTF-8, the space put before the text removed."""
        size = self.piece_len[ids]
        flat = self.piece_bytes[spread(self.piece_start[ids], size)].tobytes()
        ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(counts)]].tolist()
        out = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            raw = flat[a:b]
            raw = raw[1:] if raw[:1] == b" " else raw
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(_lossy(raw))
        return out


def _lossy(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that starts no character."""
    out, i = [], 0
    while i < len(raw):
        for k in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + k].decode())
                i += k
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


class Encoder:
    """Encodes texts word by word through a bounded table of words."""

    _WORD = re.compile(f"{META}?[^{META}\n]+|{META}+(?={META}[^{META}\n])|{META}+|\n+")

    _LONE = re.compile(f"{META}(?=[{META}\n]|$)")

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.start, self.count = np.zeros(1 << 16, dtype=np.int32), np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _add(self, words: list[str]) -> None:
        ids, counts = self.model.encode_words(words)
        n, need = len(self.number), self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.r_[self.ids[: self.used], np.zeros(need, dtype=np.int32)]
        if n + len(words) > len(self.start):
            more = np.zeros(n + len(words), dtype=np.int64)
            self.start, self.count = np.r_[self.start[:n], more], np.r_[self.count[:n], more]
        self.ids[self.used : need] = ids
        self.start[n : n + len(words)] = self.used + np.cumsum(counts) - counts
        self.count[n : n + len(words)] = counts
        self.number.update(zip(words, range(n, n + len(words)), strict=True))
        self.used = need

    def words(self, text: str) -> list[str]:
        """The parts of a text that no piece crosses.  Text begins with one more white space."""
        if not text:
            return []
        text = META + text.replace(" ", META)
        words = self._WORD.findall(text)
        return self._runs(words) if self._LONE.search(text) else words

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and the number of ids of each text."""
        if len(self.number) > TABLE_WORDS:
            self.clear()
        words: list[str] = []
        sizes = np.zeros(len(texts) + 1, dtype=np.int64)
        for k, t in enumerate(texts, 1):
            words += self.words(t)
            sizes[k] = len(words)
        numbers = list(map(self.number.get, words))
        if None in numbers:
            self._add(list({w for w, n in zip(words, numbers, strict=True) if n is None}))
            numbers = list(map(self.number.get, words))
        flat = np.array(numbers, dtype=np.int64)
        counts = self.count[flat]
        ids = self.ids[spread(self.start[flat], counts)] if len(flat) else np.zeros(0, dtype=np.int32)
        return ids, np.diff(np.r_[0, np.cumsum(counts)][sizes])

    def _runs(self, words: list[str]) -> list[str]:
        """White space before a word joins the word's own first one where that stays alone; long runs in pieces of the longest."""
        if not self.model.runs_last:
            return self._joined(words)
        out: list[str] = []
        longest = max(self.model.run_ids)
        for i, w in enumerate(words):
            if w[0] != META or w.strip(META):
                if out and w[0] == META and i and set(words[i - 1]) == {META} and self._lone(w):
                    run = len(words[i - 1]) + 1
                    del out[len(out) - self._pieces(len(words[i - 1]), longest) :]
                    out += [META * longest] * (run // longest) + ([META * (run % longest)] if run % longest else [])
                    w = w[1:]
                out.append(w)
            else:
                out += [META * longest] * (len(w) // longest) + ([META * (len(w) % longest)] if len(w) % longest else [])
        return out

    @staticmethod
    def _pieces(run: int, longest: int) -> int:
        return run // longest + bool(run % longest)

    def _lone(self, word: str) -> bool:
        if word not in self.number:
            self._add([word])
        k = self.number[word]
        return bool(self.ids[self.start[k]] == self.model.run_ids.get(1, -1))

    @staticmethod
    def _joined(words: list[str]) -> list[str]:
        out: list[str] = []
        for w in words:
            if out and set(out[-1]) == {META} and w[0] == META:
                out[-1] += w
            else:
                out.append(w)
        return out


def _slices(batch: pa.RecordBatch, sizes: list[int], most: int) -> Iterator[pa.RecordBatch]:
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    yield batch.slice(at)


_MODELS: dict[bytes, tuple[PieceModel, Encoder]] = {}


def _model(proto: bytes) -> tuple[PieceModel, Encoder]:
    """One model and one table of words for each Python worker."""
    if proto not in _MODELS:
        _MODELS.clear()
        model = PieceModel(proto)
        _MODELS[proto] = model, Encoder(model)
    return _MODELS[proto]


def read_model(path: str) -> bytes:
    """The model file, half a megabyte, read by the driver; executors get its bytes."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, proto: bytes, text_col: str = "text", out: str = "ids") -> DataFrame:
    """df with out, the ids of the whole text as array<int>, without begin or end ids.  Null and empty: no ids.

    Rows stay as they are, repeated ones too; a column named out is replaced; an empty table stays empty.
    """
    return _mapped(df, proto, text_col, out, "array<int>", _encode_batch)


def decode(df: DataFrame, proto: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """df with out, the text of the ids.  Null and no ids: empty text."""
    return _mapped(df, proto, ids_col, out, "string", _decode_batch)


def _encode_batch(column: pa.Array, held: tuple[PieceModel, Encoder]) -> pa.Array:
    ids, counts = held[1].encode([t or "" for t in column.to_pylist()])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids, pa.int32()))


def _decode_batch(column: pa.Array, held: tuple[PieceModel, Encoder]) -> pa.Array:
    counts = np.nan_to_num(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
    ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.array(held[0].decode(ids, counts), pa.string())


def _mapped(df: DataFrame, proto: bytes, source: str, out: str, kind: str, body) -> DataFrame:
    rest = [c for c in df.columns if c != out]
    value = F.col(f"`{source}`") if kind != "string" else F.col(f"`{source}`").cast("array<int>")
    src = df.select(*(F.col(f"`{c}`") for c in rest), (value.cast("string") if kind != "string" else value).alias("__in"))
    fields = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest), f"`{out}` {kind}"])
    held = df.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(held.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.num_columns - 1)
            sizes = (column.value_lengths() if kind == "string" else pa.compute.binary_length(column)).fill_null(0).to_pylist()
            for part in _slices(batch, sizes, SLICE_IDS if kind == "string" else SLICE_BYTES):
                last = body(part.column(part.num_columns - 1), model)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], last], names=[*part.schema.names[:-1], out])

    return src.mapInArrow(run, fields)
