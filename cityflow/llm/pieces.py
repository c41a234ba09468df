"""SentencePiece encoding and decoding by suffix-array matching.

What is new in a batch is put into one text and indexed by a suffix array; each piece of the vocabulary is looked
up by binary search, and its range of suffixes gives all its places. The places, as edges of a graph over
positions, are sorted by where they end and relaxed in that order: the last piece of a prefix is the one edge whose
start can be reached and that stands next to the last piece there as merging would have it. Two pieces can stand
next to each other if, while each is merged from its characters, nothing across their border would have merged
first. Texts are cut in front of spaces, which no piece reaches across, and every distinct part is encoded once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, slices, text_of

SPACE = "▁"
#: Most parts a worker remembers; beyond, it starts anew.
REMEMBERED = 600_000

#: New parts that are indexed together.
TOGETHER = 60_000

# A part is spaces and what follows them, or the character that marks the end of parts in the index.
_PARTS = re.compile(" *[^ \0]+| +(?=\0)| +$|\0")
_END = "\0"


def parts_of(text: str) -> list[str]:
    """Parts of a text with a space put in front; nothing for an empty text.

    A part with one space is named by what follows it, one without a space has the mark of the end before it.
    """
    if not text:
        return []
    if "  " not in text and _END not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    named = []
    for part in _PARTS.findall(" " + text):
        if part == _END or part[:2] == "  " or part == " ":
            named.append(part)
        else:
            named.append(part[1:] if part[0] == " " else _END + part)
    return named


def spelled(part: str) -> str:
    """The characters of a part, spaces marked."""
    if part[0] == _END:
        return part[1:]
    return part.replace(" ", SPACE) if part[0] == " " else SPACE + part
_NORMAL, _BYTE = 1, 6  # Fixed values: kinds of pieces in a model file.


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a text sorted by the `depth` or more characters that follow, by prefix doubling.

    Starts with as many characters as fit a number; zero stands for what is beyond the end.
    """
    letters, ranks = np.unique(codes, return_inverse=True)
    ranks = ranks.astype(np.int64) + 1
    bits = int(len(letters)).bit_length()
    width = min(62 // bits, depth)
    keys = np.zeros_like(ranks)
    for k in range(width):
        keys <<= bits
        if k < len(keys):
            keys[: len(keys) - k] |= ranks[k:]
    while width < depth:
        names = np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1
        keys = names * (len(names) + 2)
        if width < len(keys):
            keys[:-width] += names[width:]
        width *= 2
    return np.argsort(keys)


class PieceModel:
    """The pieces of a merge model with byte fallback, and encoding and decoding by them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as layout

        model = layout.ModelProto()
        model.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        rules = model.normalizer_spec
        merges = model.trainer_spec.model_type == layout.TrainerSpec.BPE and model.trainer_spec.byte_fallback
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces
        if not (merges and plain and rules.add_dummy_prefix and rules.escape_whitespaces):
            raise ValueError(f"{path} is not a merge model with byte fallback and plain text")
        self.size = len(model.pieces)
        self.unknown = self.size  # stands for a character that is no piece
        self.text = [p.piece if p.type == _NORMAL else "" for p in model.pieces]
        if any(SPACE in t.lstrip(SPACE) for t in self.text):
            raise ValueError(f"{path} has pieces that reach across spaces")
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.bytes = [t.replace(SPACE, " ").encode() for t in self.text]
        for value, i in self.byte_ids.items():
            self.bytes[i] = bytes([value])
        self.normal = np.array([i for i, t in enumerate(self.text) if t])
        self.length = np.array([len(t) for t in self.text] + [1])
        self.depth = int(self.length.max())
        # Higher scores merge first.
        self.order = np.full(self.size + 1, np.iinfo(np.int64).max)
        self.order[self.normal] = np.argsort(np.argsort([-model.pieces[i].score for i in self.normal], kind="stable"), kind="stable")
        self.letters = np.zeros((len(self.normal), self.depth), dtype=np.int64)
        for row, i in enumerate(self.normal):
            self.letters[row, : len(self.text[i])] = [ord(c) for c in self.text[i]]
        self.known: dict[str, bytes] = {_END: np.array([self.byte_ids[0]], dtype="<u4").tobytes()}
        self._merges()

    def _merges(self) -> None:
        """All pairs of pieces that merge to a piece, and how each piece comes about."""
        at = {self.text[i]: int(i) for i in self.normal}
        left, right, made = [], [], []
        for i in self.normal.tolist():
            for cut in range(1, len(self.text[i])):
                a, b = at.get(self.text[i][:cut]), at.get(self.text[i][cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(i)
        keys = np.array(left) * (self.size + 1) + np.array(right)
        order = np.argsort(keys)
        self.pair_keys, self.pair_made = keys[order], np.array(made)[order]
        # What a piece was merged from last; a character, and a piece that merging cannot make, come from themselves.
        self.left, self.right = np.arange(self.size + 1), np.arange(self.size + 1)
        self.made = np.zeros(self.size + 1, dtype=bool)
        self.made[self.unknown] = True
        rows = np.array(left), np.array(right), np.array(made)
        sizes = self.length[rows[2]]
        for size in range(1, self.depth + 1):
            self.made[self.normal[self.length[self.normal] == size]] |= size == 1
            a, b, m = (r[sizes == size] for r in rows)
            if len(m):
                good = self.made[a] & self.made[b]
                a, b, m = a[good], b[good], m[good]
                # The parts stand next to each other until the last merge, which no other across them precedes.
                good = self._side_by_side(a, b, self.order[m])
                self.left[m[good]], self.right[m[good]] = a[good], b[good]
                self.made[m[good]] = True

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place in the merge order of two neighbours, or the largest number."""
        keys = a * (self.size + 1) + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.order[self.pair_made[at]], np.iinfo(np.int64).max)

    def _side_by_side(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether merging keeps two made pieces apart, up to a merge of order `before` if there is one.

        Goes back in time along the border: of the pieces that meet there, the one merged later is taken apart.
        """
        top = np.iinfo(np.int64).max
        good = np.ones(len(a), dtype=bool)
        x, y = a.copy(), b.copy()
        # When the piece on a side became part of a larger one; the whole pieces never did.
        until_x = np.full(len(a), top) if before is None else before.copy()
        until_y = until_x.copy()
        open_rows = np.arange(len(a))
        while len(open_rows):
            p, q = x[open_rows], y[open_rows]
            across = self._merged(p, q)
            # Of equal merges the one further left goes first: that into the left piece, then that across.
            early = (across < until_x[open_rows]) & (across <= until_y[open_rows]) & (across < top)
            if before is not None:
                early &= across < before[open_rows]
            good[open_rows[early]] = False
            whole_p, whole_q = self.right[p] == p, self.left[q] == q
            order_p = np.where(whole_p, -1, self.order[p])
            order_q = np.where(whole_q, -1, self.order[q])
            going = ~early & ~(whole_p & whole_q)
            # Equal last merges: the left one came first, so the right one is taken apart first.
            apart_p = going & (order_p > order_q)
            apart_q = going & ~apart_p
            rows_p, rows_q = open_rows[apart_p], open_rows[apart_q]
            until_x[rows_p] = order_p[apart_p]
            x[rows_p] = self.right[p[apart_p]]
            until_y[rows_q] = order_q[apart_q]
            y[rows_q] = self.left[q[apart_q]]
            open_rows = open_rows[going]
        return good

    def occurrences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece occurs in a text: starts and pieces."""
        if not len(codes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        order = suffix_order(codes, self.depth)
        padded = np.concatenate([codes, np.zeros(self.depth, dtype=codes.dtype)])
        span = np.arange(self.depth)
        # Pieces with a letter that the text lacks need no search.
        possible = np.isin(self.letters, np.append(np.unique(codes), 0)).all(axis=1)
        asked, letters = self.normal[possible], self.letters[possible]
        inside = span < self.length[asked][:, None]
        rows = np.arange(len(asked))

        def bound(after: bool) -> np.ndarray:
            low, high = np.zeros(len(asked), dtype=np.int64), np.full(len(asked), len(order))
            while (busy := low < high).any():
                middle = (low + high) // 2
                there = padded[order[np.minimum(middle, len(order) - 1)][:, None] + span]
                differ = (there != letters) & inside
                first = differ.argmax(axis=1)
                equal = ~differ[rows, first]
                smaller = np.where(equal, after, there[rows, first] < letters[rows, first]) & busy
                low = np.where(smaller, middle + 1, low)
                high = np.where(busy & ~smaller, middle, high)
            return low

        low, high = bound(False), bound(True)
        many = high - low
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return order[np.repeat(low, many) + place], np.repeat(asked, many)

    def segment(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of texts, in which spaces are marked, as little-endian unsigned 32-bit."""
        # A part ends with a character that is in no piece.
        codes = np.frombuffer(_END.join([*parts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        sizes = np.array([len(p) for p in parts])
        begins = np.cumsum(sizes + 1) - sizes - 1
        starts, pieces = self.occurrences(codes)
        single = np.zeros(len(codes), dtype=bool)
        single[starts[self.length[pieces] == 1]] = True
        part_of = np.repeat(np.arange(len(parts)), sizes + 1)
        ends_part = np.zeros(len(codes), dtype=bool)
        ends_part[begins + sizes] = True
        strange = np.flatnonzero(~single & ~ends_part)
        usable = self.made[pieces]
        starts = np.concatenate([starts[usable], strange])
        pieces = np.concatenate([pieces[usable], np.full(len(strange), self.unknown)])
        ends = starts + self.length[pieces]
        level = ends - begins[part_of[starts]]
        by_end = np.argsort(level, kind="stable")
        starts, pieces, ends, level = starts[by_end], pieces[by_end], ends[by_end], level[by_end]
        borders = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(level)]]) if len(level) else np.array([0])
        last = np.full(len(codes) + 1, -1)
        first = np.zeros(len(codes) + 1, dtype=bool)
        first[begins] = True
        for lo, hi in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            s, p, e = starts[lo:hi], pieces[lo:hi], ends[lo:hi]
            opens = first[s]
            last[e[opens]] = p[opens]
            s, p, e = s[~opens], p[~opens], e[~opens]
            pairs, place = np.unique(last[s] * (self.size + 1) + p, return_inverse=True)
            fits = self._side_by_side(pairs // (self.size + 1), pairs % (self.size + 1))[place]
            last[e[fits]] = p[fits]
        # Back from the end of each part.
        at = begins + sizes
        walking = np.flatnonzero(sizes > 0)
        found_part, found_piece, found_at = [], [], []
        while len(walking):
            here = last[at[walking]]
            at[walking] -= self.length[here]
            found_part.append(walking)
            found_piece.append(here)
            found_at.append(at[walking].copy())
            walking = walking[at[walking] > begins[walking]]
        if not found_part:
            return [b""] * len(parts)
        owner, piece, place = (np.concatenate(f) for f in (found_part, found_piece, found_at))
        order = np.argsort(place, kind="stable")
        owner, piece, place = owner[order], piece[order], place[order]
        # Characters that are no piece go as their bytes.
        out = piece
        odd = np.flatnonzero(piece == self.unknown)
        if len(odd):
            spelled = [[self.byte_ids[b] for b in chr(c).encode("utf-8", "replace")] for c in codes[place[odd]].tolist()]
            repeats = np.ones(len(piece), dtype=np.int64)
            repeats[odd] = [len(x) for x in spelled]
            out, owner = np.repeat(piece, repeats), np.repeat(owner, repeats)
            out[out == self.unknown] = [b for x in spelled for b in x]
        whole = out.astype("<u4").tobytes()
        counts = np.bincount(owner, minlength=len(parts))
        stops = (np.cumsum(counts) * 4).tolist()
        return [whole[b:e] for b, e in zip([0, *stops], stops, strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit; an empty text has none."""
        split = [parts_of(text.replace(SPACE, " ")) for text in texts]
        known = self.known
        new = {p for parts in split for p in parts if p not in known}
        if len(known) + len(new) > REMEMBERED:
            known = self.known = {_END: np.array([self.byte_ids[0]], dtype="<u4").tobytes()}
            new = {p for parts in split for p in parts if p not in known}
        todo = sorted(new)
        for at in range(0, len(todo), TOGETHER):
            some = todo[at : at + TOGETHER]
            known.update(zip(some, self.segment(list(map(spelled, some))), strict=True))
        return [b"".join(map(known.__getitem__, parts)) for parts in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that encoding puts in front."""
        whole = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return whole.removeprefix(" ")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """The model of a file, once for each worker."""
    return PieceModel(path)


def _coded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in slices(batches, "text", limit=6_000_000):
            coded = model.encode(list(text_of(batch.column(1))))
            counts = np.array([len(c) // 4 for c in coded])
            values = np.frombuffer(b"".join(coded), dtype="<i4")
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            arrays = [
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())),
                pa.array(counts, pa.int64()),
                pa.array([zlib.crc32(c) for c in coded], pa.int64()),
                pa.array([model.decode(np.frombuffer(c, dtype="<u4")) for c in coded], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "n_ids", "ids_crc32", "decoded"])

    return run


def code_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of each document, and the text read back from them.

    `model` is a model file whose path is the same on all machines. Returns doc_id, ids (array), n_ids, ids_crc32
    (as little-endian unsigned 32-bit) and decoded, which is the text itself but for the mark of spaces
    (U+2581), which comes back as a space. Null texts are empty and have no ids. Null and repeated ids are rows like any
    other; other columns are not read; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_coded(model), "doc_id long, ids array<int>, n_ids long, ids_crc32 long, decoded string")


def coded_digests(coded: DataFrame) -> DataFrame:
    """Ids with the digest of the text read back, in place of the text."""
    return coded.select("doc_id", "ids", "n_ids", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"))
