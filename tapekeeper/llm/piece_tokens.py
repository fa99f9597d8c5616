"""Merge-type sentence pieces: encoding by a score-ordered agenda of adjacent symbol pairs, and decoding."""

import heapq
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapekeeper.llm.shared import byte_slices, plain, text_of

# The mark that stands for a space, the surface of an unknown piece, and a character no piece may hold.
SPACE, UNKNOWN, BREAK = "▁", " ⁇ ", "\n"

# Longest chunk whose agenda is kept as a row of a matrix; longer ones use a heap.
ROW = 48

# Chunks that a task remembers the ids of at most, chunks kept when there are more and after the task, and
# characters it works on at a time. Chunks met first are kept: they tend to be the frequent ones.
REMEMBERED, KEPT, SLICE = 400_000, 80_000, 1 << 20

NONE = np.int32(2**31 - 1)


class Pieces:
    """The pieces of one model, its merges, and the ids of chunks met before.

    No piece may run from another character into a space or hold a line break: then text falls into chunks at
    these places which merge independently, and a chunk met again need not be merged again.
    """

    def __init__(self, model_path: str):
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
        normal = sorted(set(range(size)) - set(special))
        if any(model.is_unused(i) for i in normal):
            raise ValueError("models with unused pieces are not supported")
        if any(re.search(f"[^{SPACE}]{SPACE}|{BREAK}", names[i]) for i in normal):
            raise ValueError("pieces that run over a space or a line break are not supported")
        self.ids = {names[i]: i for i in normal}
        self.unknown = model.unk_id()
        self.bytes = {int(names[i][1:-1], 16): i for i in special if model.is_byte(i)}
        self.surface = [names[i].replace(SPACE, " ").encode() for i in range(size)]
        for i in special:
            self.surface[i] = b"" if model.is_control(i) else UNKNOWN.encode()
        for value, i in self.bytes.items():
            self.surface[i] = bytes([value])
        self.byte_ids = frozenset(self.bytes.values())
        self.opens = {i for i in normal if names[i].startswith(SPACE)}
        # Rank 0 is the best score; every way to join two known strings into a piece is a pair.
        order = sorted(normal, key=lambda i: -model.get_score(i))
        self.rank = {names[i]: r for r, i in enumerate(order)}
        symbols = {name: k for k, name in enumerate(self.rank)}
        for name in list(self.rank):
            for char in name:
                symbols.setdefault(char, len(symbols))
        self.count = len(symbols)
        pairs = {symbols[name[:cut]] * self.count + symbols[name[cut:]]: rank
                 for name, rank in self.rank.items() for cut in range(1, len(name))
                 if name[:cut] in symbols and name[cut:] in symbols}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.symbol_id = np.full(self.count, -1, np.int32)
        for name, i in self.ids.items():
            self.symbol_id[symbols[name]] = i
        self.char_symbol = np.full(0x110000, -1, np.int32)
        for name, k in symbols.items():
            if len(name) == 1 and name in self.ids:
                self.char_symbol[ord(" " if name == SPACE else name)] = k
        self.known: dict[str, bytes] = {}
        self.chunks = re.compile(f" +[^ {BREAK}]*|[^ {BREAK}]+|{BREAK}")
        self.before_break = len(model.encode(BREAK))

    # --- one chunk ------------------------------------------------------------------------------

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk: the pair of the best score, the leftmost of equals, is joined until none is left."""
        parts, rank = list(chunk.replace(" ", SPACE)), self.rank
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        agenda = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(parts):
                joined = parts[left] + parts[right]
                if joined in rank:
                    heapq.heappush(agenda, (rank[joined], left, parts[left], parts[right]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while agenda:
            _, left, a, b = heapq.heappop(agenda)
            right = after[left]
            if parts[left] != a or right >= len(parts) or parts[right] != b:
                continue  # one of the two was joined with another since
            parts[left], parts[right] = a + b, ""
            after[left] = after[right]
            if after[right] < len(parts):
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        out = []
        for part in filter(None, parts):
            if part in self.ids:
                out.append(self.ids[part])
            elif self.bytes:
                out.extend(self.bytes[b] for b in part.encode("utf-8", "replace"))
            else:
                out.append(self.unknown)
        return out

    # --- many chunks at once --------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.count + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], NONE)

    def merge_rows(self, chunks: list[str], symbols: np.ndarray) -> None:
        """The same for chunks of known characters, a row of symbols each, padded with -1.

        A row's agenda is its row of pair ranks: the smallest, the leftmost of equals, is joined in
        every row at once, so all rows left get shorter by one each round.
        """
        rows = np.arange(len(chunks))
        ranks = self._ranks(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            width = symbols.shape[1]
            best = ranks.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)
            value = ranks[np.arange(len(rows)), best] if width > 1 else np.full(len(rows), NONE)
            going = value < NONE
            done = ~going
            if done.any():
                ids = np.where(symbols[done] >= 0, self.symbol_id[symbols[done]], -1).astype("<i4")
                sizes, flat = (ids >= 0).sum(axis=1).tolist(), ids.tobytes()
                for k, row in enumerate(rows[done].tolist()):
                    at = k * width * 4
                    self.known[chunks[row]] = flat[at:at + 4 * sizes[k]]
            rows, symbols, ranks, best, value = rows[going], symbols[going], ranks[going], best[going], value[going]
            if not len(rows):
                break
            each, columns = np.arange(len(rows)), np.arange(width - 1)
            symbols = np.take_along_axis(symbols, columns + (columns > best[:, None]), axis=1)
            symbols[each, best] = value  # the symbol of a piece is its rank
            ranks = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] >= best[:, None]), axis=1)
            for at in (best - 1, best):
                inside = (at >= 0) & (at < width - 2)
                i, j = each[inside], at[inside]
                ranks[i, j] = self._ranks(symbols[i, j], symbols[i, j + 1])

    def learn(self, chunks: list[str], check: bool) -> None:
        """Fills in the ids of chunks not met before and, if asked, holds them against the library."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        flat = self.char_symbol[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)]
        starts = np.cumsum(sizes) - sizes
        odd = np.add.reduceat(flat < 0, starts) > 0 if len(chunks) else np.zeros(0, bool)
        slow = odd | (sizes > ROW)
        for i in np.nonzero(slow)[0].tolist():
            self.known[chunks[i]] = np.array(self.merge(chunks[i]), "<i4").tobytes()
        order = np.nonzero(~slow)[0]
        order = order[np.argsort(sizes[order], kind="stable")]
        for first in range(0, len(order), 1 << 14):  # rows of like length, so little padding
            some = order[first:first + (1 << 14)]
            place = np.arange(int(sizes[some[-1]]))
            inside = place < sizes[some][:, None]
            matrix = np.where(inside, flat[np.where(inside, starts[some][:, None] + place, 0)], -1).astype(np.int32)
            self.merge_rows([chunks[i] for i in some.tolist()], matrix)
        if check:
            self.verify(chunks)

    def verify(self, chunks: list[str]) -> None:
        """Raises if the library splits a chunk otherwise. After a break a chunk is encoded as inside a text."""
        texts = [BREAK + chunk for chunk in chunks]
        found, skip = self.library.encode(texts, num_threads=1), self.before_break
        own = [self.known[chunk] for chunk in chunks]
        flat = np.fromiter(chain.from_iterable(ids[skip:] for ids in found), "<i4")
        if [len(x) // 4 + skip for x in own] != list(map(len, found)) or flat.tobytes() != b"".join(own):
            bad = next(c for c, ids in zip(chunks, found) if np.array(ids[skip:], "<i4").tobytes() != self.known[c])
            raise ValueError(f"the library encodes {bad!r} otherwise")

    def forget(self) -> None:
        """Keeps the ids of the chunks met first only; the others are merged again when met again."""
        self.known = dict(islice(self.known.items(), KEPT))

    # --- whole texts ----------------------------------------------------------------------------

    def encode(self, texts: list[str], check: bool = True) -> list[bytes]:
        """Ids of whole texts, each as little-endian 32-bit numbers."""
        # The mark itself counts as a space. Chunks keep plain spaces, which makes them small strings.
        split = [self.chunks.findall(" " + text.replace(SPACE, " ")) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        found = [list(map(self.known.get, chunks)) for chunks in split]
        gaps = [[i for i, ids in enumerate(of) if ids is None] if None in of else () for of in found]
        new = {chunks[i] for chunks, empty in zip(split, gaps) for i in empty}
        if new:
            self.learn(list(new), check)
        for chunks, of, empty in zip(split, found, gaps):
            for i in empty:
                of[i] = self.known[chunks[i]]
        return [b"".join(of) for of in found]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, the first space that encoding adds taken off, bytes that form no character replaced."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text, run = "", b""
            for i in [*ids, None]:
                if i in self.byte_ids:
                    run += self.surface[i]
                    continue
                text += run.decode("utf-8", "one mark a byte")
                run = b""
                text += "" if i is None else self.surface[i].decode()
        first = next((i for i in ids if self.surface[i]), None)
        return text[1:] if first in self.opens else text


def _mark(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


_loaded: dict[str, Pieces] = {}


def pieces_of(model_path: str) -> Pieces:
    """The model's pieces, loaded once per Python worker."""
    import codecs

    codecs.register_error("one mark a byte", _mark)
    if model_path not in _loaded:
        _loaded[model_path] = Pieces(model_path)
    return _loaded[model_path]


def encode_pieces(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text",
                  check: bool = True) -> DataFrame:
    """(id, ids, decoded) per row: the whole text's piece ids, and the text they decode to.

    No begin or end ids, no sampling; null text is empty text and has no ids. With ``check`` every
    chunk that a task meets first is encoded by the sentencepiece library as well, a batch at a
    time, and a difference stops the job.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in byte_slices(texts, SLICE):
                ids = pieces.encode(texts[first:last], check)
                flat = np.frombuffer(b"".join(ids), "<i4")
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
                decoded = [pieces.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                     pa.array(decoded, pa.string())], names=["id", "ids", "decoded"])
        pieces.forget()  # an idle worker holds little

    rows = docs.select(plain(id_column).alias("id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded string")
