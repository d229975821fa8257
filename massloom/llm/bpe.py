"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks."""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from massloom.llm.common import keyed, slices

#: The split pattern of the vocabulary's pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters and digits that the regex module knows and the tokenizers library, with an older Unicode, does not.
NEWER = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A "
    "11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
#: Pieces looked up together, pieces remembered by a worker, leaves of the trees that are merged together.
PIECES, MEMORY, SLOTS = 1 << 18, 400_000, 1 << 16
#: Characters of a text that are cut into pieces at once.
BLOCK = 1 << 20
_NONE = np.iinfo(np.int64).max


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte: itself if it is printable Latin-1, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, spare = {chr(b): b for b in printable}, 0x100
    for b in range(256):
        if b not in printable:
            names[chr(spare)] = b
            spare += 1
    return names


class Vocabulary:
    """Merges, ids and added tokens of a tokenizer file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names, vocab = _byte_names(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(names[c] for c in token) for token, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of.update({i: content.encode() for content, i in self.added.items()})
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for char, b in names.items():
            self.byte_ids[b] = vocab[char]
        pairs = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pairs.append(((vocab[left] << 32) | vocab[right], rank, vocab[left + right]))
        pairs.sort()
        self.keys = np.array([k for k, _, _ in pairs], dtype=np.int64)
        self.ranks = np.array([r for _, r, _ in pairs], dtype=np.int64)
        self.merged = np.zeros(len(pairs), dtype=np.int64)
        self.merged[self.ranks] = [m for _, _, m in pairs]
        newer = "".join("-".join(f"\\U{int(x, 16):08X}" for x in span.split("-")) for span in NEWER.split())
        self.split_latin = regex.compile(PATTERN)
        self.split_any = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]").replace(r"\p{L}+|", rf"[\p{{L}}--[{newer}]]+|").replace(r"\p{N}+|", rf"[\p{{N}}--[{newer}]]+|"), regex.V1)
        self.split_added = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; _NONE where there is no merge."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_pieces(pieces: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Little-endian ids of each piece. Pieces of one padded size are merged together, a segment tree each."""
    out = [b""] * len(pieces)
    by_size: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        by_size.setdefault(1 << max(1, (len(piece) - 1).bit_length()), []).append(k)
    for size, members in by_size.items():
        step = max(1, SLOTS // size)
        for at in range(0, len(members), step):
            part = members[at:at + step]
            for k, ids in zip(part, _merge([pieces[k] for k in part], size, vocab), strict=True):
                out[k] = ids
    return out


def _merge(pieces: list[bytes], size: int, vocab: Vocabulary) -> list[bytes]:
    """Merge pieces of at most ``size`` bytes (a power of two).

    Column w of ``tree`` is the segment tree of piece w. Leaf ``size + i`` holds rank * size + i of the pair that
    begins at slot i, so the root is the leftmost pair of the lowest rank. A merge changes three leaves: its own,
    that of the pair before it, and that of the slot it swallows; each is renewed up to the root.
    """
    count = len(pieces)
    kind = np.int32 if len(vocab.ranks) * size < np.iinfo(np.int32).max else np.int64
    none = np.iinfo(kind).max
    lengths = np.array([len(p) for p in pieces])
    raw = np.zeros((count, size), dtype=np.uint8)
    raw[np.arange(size) < lengths[:, None]] = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    ids = np.where(np.arange(size)[:, None] < lengths, vocab.byte_ids[raw.T], -1)
    after = np.tile(np.arange(1, size + 1, dtype=np.int32)[:, None], count)
    before = np.tile(np.arange(-1, size - 1, dtype=np.int32)[:, None], count)

    def leaf(left: np.ndarray, right: np.ndarray, slot: np.ndarray) -> np.ndarray:
        rank = vocab.rank(left, right)
        return np.where(rank == _NONE, none, np.where(rank == _NONE, 0, rank) * size + slot).astype(kind)

    tree = np.full((2 * size, count), none, dtype=kind)
    tree[size:2 * size - 1] = leaf(ids[:-1], ids[1:], np.arange(size - 1)[:, None])
    for node in range(size - 1, 0, -1):
        np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])
    flat = tree.ravel()

    def renew(slots: np.ndarray, columns: np.ndarray, values: np.ndarray | int) -> None:
        node = slots + size
        flat[node * count + columns] = values
        for _ in range(size.bit_length() - 1):
            node >>= 1
            place = node * (2 * count) + columns
            flat[node * count + columns] = np.minimum(flat[place], flat[place + count])

    open_ = np.nonzero(tree[1] != none)[0]
    while len(open_):
        root = tree[1, open_].astype(np.int64)
        left = root % size
        gone = after[left, open_].astype(np.int64)
        new = vocab.merged[root // size]
        ids[left, open_] = new
        ids[gone, open_] = -1
        right = after[gone, open_].astype(np.int64)
        after[left, open_] = right
        linked = right < size
        before[right[linked], open_[linked]] = left[linked]
        following = np.where(linked, ids[np.where(linked, right, 0), open_], -1)
        renew(gone, open_, none)
        renew(left, open_, np.where(following >= 0, leaf(new, np.maximum(following, 0), left), none))
        previous = before[left, open_].astype(np.int64)
        has = previous >= 0
        if has.any():
            previous, columns = previous[has], open_[has]
            renew(previous, columns, leaf(ids[previous, columns], new[has], previous))
        open_ = open_[tree[1, open_] != none]
    rows = ids.T
    there = rows >= 0
    packed = rows[there].astype("<u4").tobytes()
    ends = (4 * np.cumsum(there.sum(1))).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Encoder:
    """Texts to little-endian ids and back; remembers the pieces it has met, up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.known = vocab, {}

    def pieces(self, text: str) -> Iterator[str | int]:
        """The text cut by the pattern; an added token comes as its id."""
        parts = self.vocab.split_added.split(text) if self.vocab.split_added else [text]
        for part in parts:
            if part in self.vocab.added:
                yield self.vocab.added[part]
            elif part:
                try:
                    part.encode("latin-1")
                    pattern = self.vocab.split_latin
                except UnicodeEncodeError:
                    pattern = self.vocab.split_any
                yield from pattern.findall(part) if len(part) < BLOCK else (m.group() for m in pattern.finditer(part))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, four bytes each. Texts are taken together up to PIECES; a longer one goes block by block."""
        out: list[list[bytes]] = []
        held: list[tuple[int, list[str | int]]] = []
        size = 0
        for k, text in enumerate(texts):
            out.append([])
            stream = self.pieces(text)
            while block := list(itertools.islice(stream, PIECES)):
                held.append((k, block))
                size += len(block)
                if size >= PIECES:
                    self._append(held, out)
                    held, size = [], 0
        self._append(held, out)
        return [b"".join(x) for x in out]

    def _append(self, held: list[tuple[int, list[str | int]]], out: list[list[bytes]]) -> None:
        known = self.known
        met = set().union(*(block for _, block in held))
        new = met.difference(known)
        if len(known) + len(new) > MEMORY:
            known.clear()
            new = met
        words = [p for p in new if isinstance(p, str)]
        known.update((p, p.to_bytes(4, "little")) for p in new if isinstance(p, int))
        known.update(zip(words, merge_pieces([w.encode("utf-8", "surrogatepass") for w in words], self.vocab), strict=True))
        for k, block in held:
            out[k].append(b"".join(map(known.__getitem__, block)))

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self.vocab.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


def _rows(docs: DataFrame, path: str, decode: bool, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for part in slices(batches):
            encoded = encoder.encode(part.column(1).to_pylist())
            columns = [part.column(0), part.column(2), pa.array([len(x) // 4 for x in encoded], pa.int64()), pa.array(encoded, pa.binary())]
            if decode:
                columns.append(pa.array([encoder.decode(x) for x in encoded], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_tokens", "ids", *(["decoded"] if decode else [])])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key long, n_tokens long, ids binary" + (", decoded string" if decode else ""))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text under the byte-level tokenizer file at ``path``.

    Result: doc_id, text_key, n_tokens, ids (little-endian unsigned 32-bit). Strings of added tokens in a text become
    their id, as the tokenizers library does. Null and empty texts have no ids. One row per row of the input; a null
    doc_id stays null; an empty table gives no rows. ``path`` must exist on every executor.
    """
    return _rows(docs, path, False, id_col, text_col)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with ``decoded``: the text read back from the ids."""
    return _rows(docs, path, True, id_col, text_col)
