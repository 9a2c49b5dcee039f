"""The tokenization automaton against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import bpe
from tidemark.llm.registry import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


def texts():
    rng = random.Random(11)
    pick = lambda letters, n: "".join(rng.choices(letters, k=n))
    fixed = [None, "", " ", "\n\n \t", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoft", "I'll they'RE 's", "a" * 700, "ha" * 300 + " " * 60, "é🙂 ñ́ 中文字 ​\x00",
             "x" * 3 + "  y", "12345 1,000.5%"]
    mixed = [pick("abcdeth nr\n.,'1é🙂", 300) for _ in range(60)] + [pick("aab \x85\xa0", 80) for _ in range(60)] + [pick("tionhe er", 500) for _ in range(40)]
    return fixed + mixed


def test_equals_the_library(docs):
    rows = list(enumerate(texts()))
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = []
    for doc, text in [*rows, rows[5]]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert decoded == (text or "")
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids))
    got = bpe.encoded(docs(*rows, rows[5]), tokenizer_path()).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got) == sorted(want)


def test_empty_table_and_no_ids(docs):
    out = bpe.encoded(docs((1, "x")).limit(0), tokenizer_path(), with_ids=False)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0


def test_cut_off_bytes_decode_to_replacement_characters():
    with open(tokenizer_path(), encoding="utf-8") as file:
        automaton = bpe.compiled(file.read())
    ids = automaton.encode("🙂")
    assert len(ids) > 1 and automaton.decode(ids) == "🙂" and "�" in automaton.decode(ids[:1])
