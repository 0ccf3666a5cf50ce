"""Pieces of texts that the token store encodes once."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from tessera.llm import token_store


def test_marks_end_pieces_of_letters():
    data = "one***two (three) it's 5%off a/b\n".encode()
    at = np.flatnonzero(token_store.piece_starts(np.frombuffer(data, np.uint8))).tolist()
    pieces = [data[a:z].decode() for a, z in zip([0, *at], [*at, len(data)])]
    assert pieces == ["one", "***two", " (three", ")", " it's", " 5%off", " a", "/b", "\n"]


def test_pieces_give_the_librarys_ids():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = token_store.load(f.read())
    assert encoder.by_piece
    rng = np.random.default_rng(11)
    signs = [*"ab zZ09.,;:!?\"#$%&()*+/=@'-_<>|[]{}~^`\\\n\t\r", "'s", "'ll", "é", "ß", "́", "中", " ", "<|endoftext|>", "  ", "word"]
    texts = ["".join(rng.choice(signs, size=rng.integers(0, 60))) for _ in range(4000)]
    ids, n = encoder.encode_column(pa.array(texts))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
