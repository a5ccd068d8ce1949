"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of a prefix has exactly one last token: the token that ends there
and that no merge across its left border would ever have joined to the last
token of the prefix before it. So one pass over a piece suffices. An automaton
lists the tokens that are suffixes of what has been read, a pair test picks the
one that holds, and the ids are read off the stored tokens from the end.

The vocabulary is read on the driver (its size is the file's, a few MB) and
broadcast; texts are encoded in Spark tasks, one batch of rows at a time, with
a bounded memory of pieces already encoded.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array

import ahocorasick
import regex
from pyspark.sql import DataFrame

from skytally.llm.common import Memo, lasting, map_texts

#: The pattern that cuts text into pieces before merging; a fixed value of byte-level vocabularies.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space is the Unicode property; the regex module's own class also has four separators of ASCII.
PIECES = PIECES.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")

MEMO_PIECES = 300_000
MEMO_PAIRS = 500_000


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Encodes and decodes with one vocabulary; built from the text of a tokenizer file."""

    def __init__(self, definition: str):
        self.definition = definition
        spec = json.loads(definition)
        byte_of = _byte_characters()
        plain = {w: i for w, i in spec["model"]["vocab"].items() if all(c in byte_of for c in w)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        ids = {w: i for w, i in plain.items() if w not in self.special}
        self.token_bytes = {i: bytes(byte_of[c] for c in w) for w, i in ids.items()}
        self.token_bytes |= {i: w.encode() for w, i in self.special.items()}

        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank = {i: -1 for i in ids.values()}
        for order, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (ids[left], ids[right]), ids[left + right]
            if whole in self.parts:
                raise ValueError(f"two merges make the token {left + right!r}")
            self.merge_rank[pair], self.parts[whole], self.rank[whole] = order, pair, order

        self.suffixes = ahocorasick.Automaton()
        reachable: dict[int, bool] = {}
        for token in sorted(self.rank, key=self.rank.get):
            pair = self.parts.get(token)
            size = len(self.token_bytes[token])
            if pair is None:
                reachable[token] = size == 1
            else:
                sound = reachable[pair[0]] and reachable[pair[1]]
                reachable[token] = sound and self._apart(*pair, before=self.rank[token])
            if reachable[token]:
                self.suffixes.add_word(self.token_bytes[token].decode("latin-1"), (token, size))
        self.suffixes.make_automaton()
        self.pair_holds = Memo(lambda pair: self._apart(*pair), MEMO_PAIRS)
        self.memo = Memo(self._piece_ids, MEMO_PIECES)
        self.find_pieces = regex.compile(PIECES).findall
        names = sorted(self.special, key=len, reverse=True)
        self.find_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    @classmethod
    def from_file(cls, path: str) -> Encoder:
        with open(path, encoding="utf-8") as f:
            return cls(f.read())

    def __reduce__(self):
        return (Encoder, (self.definition,))

    def _apart(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether no merge of rank below ``before`` joins the two tokens across their border.

        Goes back through the merges that made the two, the latest first. A pair
        of pieces at the border merges if that comes before either piece is used
        up; of equal merges the one further left comes first.
        """
        left_until = right_until = before
        while True:
            merge = self.merge_rank.get((left, right))
            if merge is not None and merge < left_until and merge <= right_until:
                return False
            if self.rank[left] > self.rank[right]:
                left_until, left = self.rank[left], self.parts[left][1]
            elif self.rank[right] >= 0:
                right_until, right = self.rank[right], self.parts[right][0]
            else:
                return True

    def _piece_ids(self, piece: str) -> bytes:
        """Ids of one piece as unsigned 32-bit integers."""
        data = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        last: list[int] = [-1] * (len(data) + 1)
        holds = self.pair_holds
        sizes = {}
        for end, (token, size) in self.suffixes.iter(data):
            if last[end + 1] < 0:
                start = end + 1 - size
                if start == 0 or (last[start] >= 0 and holds[last[start], token]):
                    last[end + 1] = token
                    sizes[end + 1] = size
        ids, at = array("I"), len(data)
        while at:
            ids.append(last[at])
            at -= sizes[at]
        ids.reverse()
        return ids.tobytes()

    def encode(self, text: str) -> array:
        """Ids of the text; strings of special tokens in it become those tokens."""
        memo, out = self.memo, []
        parts = self.find_special.split(text) if self.find_special and any(s in text for s in self.special) else [text]
        for part in parts:
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
            else:
                out.append(b"".join([memo[p] for p in self.find_pieces(part)]))
        ids = array("I")
        ids.frombytes(b"".join(out))
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def _coder(shared) -> Encoder:
    """A worker's encoder, which its tasks share with its memory of pieces, until it turns to something else."""
    return lasting(lambda: shared.value)


def encode_texts(docs: DataFrame, encoder: Encoder) -> DataFrame:
    """``(doc_id, ids)`` for documents(doc_id, text): the token ids of each whole text.

    A null or empty text has no ids; every row gives one row, repeated ones too;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(encoder)

    def setup():
        coder = _coder(shared)
        return lambda text: (coder.encode(text or ""),)

    return map_texts(docs, setup, {"ids": "array<int>"})


def decode_ids(encoded: DataFrame, encoder: Encoder) -> DataFrame:
    """``(doc_id, text)`` for rows of (doc_id, ids); null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(encoder)

    def setup():
        coder = _coder(shared)
        return lambda ids: (None if ids is None else coder.decode(ids),)

    return map_texts(encoded, setup, {"text": "string"}, column="ids")


def encoded_texts(docs: DataFrame, encoder: Encoder) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)``: each text encoded, decoded again and compared.

    Nulls, repeats and other columns as in ``encode_texts``; a null text counts as an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(encoder)

    def setup():
        coder = _coder(shared)

        def encoded(text):
            ids, text = coder.encode(text or ""), text or ""
            if coder.decode(ids) != text:
                raise ValueError("the ids of a text do not decode to it")
            return len(ids), ids, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

        return encoded

    return map_texts(docs, setup, {"n_tokens": "long", "ids": "array<int>", "decoded_sha256": "string"})


def encoded_digests(docs: DataFrame, encoder: Encoder) -> DataFrame:
    """Each text encoded and decoded again in one pass: token count and the digests of ids and text.

    Nulls, repeats and other columns as in ``encode_texts``; a null text counts as an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(encoder)

    def setup():
        coder = _coder(shared)

        def digests(text):
            ids = coder.encode(text or "")
            back = coder.decode(ids).encode("utf-8", "surrogatepass")
            if sys.byteorder != "little":
                ids.byteswap()
            return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()

        return digests

    return map_texts(docs, setup, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})
