"""BPE encoding and decoding with a tokenization automaton.

The merge list is compiled, merge by merge in rank order, into a deterministic
automaton over tokens. It starts with one state per byte and an arc from every
state to every byte. The gadget of merge (u, v) removes the arc on v from the
state of u, and adds a state for uv whose outgoing arcs are those v has at that
moment and whose incoming arcs are those u has at that moment. What the finished
automaton accepts is exactly one token sequence for every byte string, the one the
merge list gives.

A full arc table has vocabulary**2 entries, so arcs are stored by difference: the
removed arc of each merge, and for each token the two it was made of with the rank
at which it took over their arcs. An arc t -> x is absent if and only if some merge
(a, b) removed it from ancestors a of t (down its right parts) and b of x (down its
left parts) before either was left behind. Token starts come from a trie of the
labels. Words, cut by the pre-tokenizer, run through these tables; the one accepted
path is the encoding, and decoding emits the labels of its arcs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import textbytes as B

#: Splits text before the merges, as the byte-level pre-tokenizer does.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct words whose encodings a task keeps before it starts anew.
MEMORY = 400_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-in for each byte: printable Latin-1 characters stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Tables of the compiled merge list, and the added tokens that are cut out first."""

    def __init__(self, spec: dict):
        letters = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.labels: dict[int, bytes] = {i: bytes(letters[c] for c in s) for s, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.added_labels = {i: s.encode() for s, i in self.added.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = regex.compile(PATTERN)
        # removed[a, b]: rank of the merge whose gadget removed the arc on b from the state of a
        self.removed: dict[tuple[int, int], int] = {}
        # born: rank of the gadget that made a token; left, right: what it was made of
        size = max(vocab.values()) + 1
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        for rank, pair in enumerate(spec["model"]["merges"]):
            u, v = pair if isinstance(pair, list) else pair.split(" ")
            self._gadget(vocab[u], vocab[v], vocab[u + v], rank)
        states = {i for i in self.labels if len(self.labels[i]) == 1 or self.born[i] >= 0}
        # trie of the labels: children by byte, and the token that ends there
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for i in states:
            node = 0
            for b in self.labels[i]:
                step = self.children[node].get(b)
                if step is None:
                    step = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = step
            self.ends[node] = i
        self.memory: dict[str, list[int]] = {}

    def _gadget(self, u: int, v: int, made: int, rank: int) -> None:
        self.removed.setdefault((u, v), rank)
        if self.born[made] < 0:
            self.born[made], self.left[made], self.right[made] = rank, u, v

    def arc(self, t: int, x: int) -> bool:
        """Whether the state of t has an arc on x.

        Walks back through the gadgets that made the two, the later one first. A
        removal counts up to the gadget just undone: not including it on the left,
        including it on the right, since equal merges apply from the left.
        """
        removed, born = self.removed, self.born
        limit = len(removed)
        while True:
            rank = removed.get((t, x))
            if rank is not None and rank < limit:
                return False
            if born[t] > born[x]:
                limit, t = born[t], self.right[t]
            elif born[x] < 0:
                return True
            else:
                limit, x = born[x] + 1, self.left[x]

    def path(self, word: bytes) -> list[int]:
        """The one accepted token path over the bytes, longest arcs first.

        Every prefix has one path only, so a place from which the sweep had to
        turn back lies on no accepted path and is never entered again.
        """
        n, children, ends = len(word), self.children, self.ends
        path: list[int] = []
        places, choices = [0], []
        closed = bytearray(n + 1)
        i, fresh = 0, True
        while i < n:
            if fresh:
                node, j, found = 0, i, []
                while j < n:
                    node = children[node].get(word[j], -1)
                    if node < 0:
                        break
                    j += 1
                    if ends[node] >= 0:
                        found.append((ends[node], j))
                choices.append(found)
            found = choices[-1]
            fresh = False
            while found:
                token, j = found.pop()
                if not closed[j] and (not path or self.arc(path[-1], token)):
                    path.append(token)
                    places.append(j)
                    i, fresh = j, True
                    break
            if not fresh:
                closed[i] = 1
                choices.pop()
                places.pop()
                path.pop()
                i = places[-1]
        return path

    def word(self, piece: str) -> list[int]:
        """Encoding of one pre-split word, remembered within bounds."""
        found = self.memory.get(piece)
        if found is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            found = self.memory[piece] = self.path(piece.encode())
        return found

    def encode(self, text: str) -> list[int]:
        """Token ids of a whole text; added tokens are cut out before words."""
        out: list[int] = []
        remembered = self.memory.get
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.added:
                out.append(self.added[part])
                continue
            for piece in self.words.findall(part):
                found = remembered(piece)
                out += self.word(piece) if found is None else found
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the arc labels; bytes that are no UTF-8 become replacement characters."""
        labels, added = self.labels, self.added_labels
        return b"".join([labels[i] if i in labels else added[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def compiled(spec: str) -> Automaton:
    """The automaton of a tokenizer file's text, built once per process."""
    return Automaton(json.loads(spec))


def encoded(documents: DataFrame, tokenizer_path: str, with_ids: bool = True) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    ids_sha256 digests the ids as little-endian unsigned 32-bit integers,
    decoded_sha256 the decoded text. The tokenizer file is read on the driver and
    its text broadcast; its size is fixed by the vocabulary.

    Defined cases: a null or empty text has no tokens and decodes to the empty
    text; whole texts of any length are encoded; repeated rows give repeated rows;
    other columns are not read; an empty table gives an empty table.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = documents.sparkSession.sparkContext.broadcast(file.read())
    keyed = documents.select("doc_id", "text")
    fields = [keyed.schema["doc_id"], *T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string").fields]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    names = schema.fieldNames()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(spec.value)
        for batch in batches:
            for p in B.pieces(batch.column("text")):
                counts, shas, texts, flat = [], [], [], []
                for a, b in zip(p.offsets[:-1].tolist(), p.offsets[1:].tolist()):
                    ids = automaton.encode(p.text(a, b))
                    packed = np.array(ids, "<u4")
                    counts.append(len(ids))
                    shas.append(hashlib.sha256(packed.tobytes()).hexdigest())
                    texts.append(hashlib.sha256(automaton.decode(ids).encode()).hexdigest())
                    if with_ids:
                        flat.append(packed.astype(np.int32))
                columns = [batch.column("doc_id").slice(p.first, p.last - p.first), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())]
                if with_ids:
                    columns.append(B.list_array(np.concatenate(flat) if flat else np.zeros(0, np.int32), np.r_[0, np.cumsum(counts)]))
                yield pa.RecordBatch.from_arrays(columns, names)

    return keyed.mapInArrow(scan, schema)
