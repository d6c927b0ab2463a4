"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tickframe.llm import blocks as B
from tickframe.llm import bpe
from tickframe.llm import codepoints as C

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CODEC = bpe.Codec(PATH)
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})
HARD = ["", " ", "  ", "a", "'s", "''s", " 's", "\n's", "x's", "it's we'll I'd'd'ver", "'s's's", "a'lls", "'l", "'r e", "!'s", " 's",
        "  a", " \n a", "\n\na", "a  \n", "a 　b", "　　b", "　", "1a²½Ⅷ一", "é́ üß", "🙂👍🏽 's", " \t!x", "...  ...", "a\r\n\r\nb", "Ω's",
        "<|endoftext|>", "\x00\x1c\x1f a", "x" * 300, "the " * 500, "z" * 70 + " " * 90 + "!" * 130, "ab" * 3000]


def _texts():
    rng = random.Random(5)
    alphabet = list("aabest'' \n\t!1é一 　🙂ñ.lvrdm") + ["'s", "'ll", "  "]
    return HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]


def _encode(texts):
    out = []
    for rows, data, offsets in B.blocks([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})], "text", 4096):
        out += list(CODEC.encode(data, offsets))
    return out


def test_ids_equal_the_library_and_decode_back():
    texts = _texts()
    for text, ids in zip(texts, _encode(texts), strict=True):
        assert ids == TIK.encode_ordinary(text), repr(text)
        assert CODEC.decode(ids) == text.encode()


def test_classes_equal_the_library_on_every_code_point():
    cps = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    kinds, ranks = C.Classes().kinds(np.array(cps, np.uint32)), {bytes([i]): i for i in range(256)}
    for cls, pat in ((C.LETTER, r"\p{L}"), (C.NUMBER, r"\p{N}"), (C.SPACE, r"\s")):
        lib = tiktoken.Encoding(pat, pat_str=pat, mergeable_ranks=ranks, special_tokens={})  # keeps the matches alone
        assert set(map(ord, bytes(lib.encode_ordinary("".join(map(chr, cps)))).decode())) == {c for c, k in zip(cps, kinds) if k == cls}


def test_frame_operators(spark):
    rows = [(1, None, "q"), (2, "it's  fine\n\nñ 12", "q"), (2, "it's  fine\n\nñ 12", "q"), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    with pytest.raises(Exception):
        df.select("nothing")
    enc = bpe.encode(df, PATH)
    back = bpe.decode(enc, PATH).collect()
    assert sorted((bytes(r.decoded).decode() for r in back)) == sorted((r[1] or "") for r in rows)
    assert all(list(r.token_ends)[-1:] in ([len((r.text or "").encode())], []) for r in back)
    digest = bpe.round_trip(df.select("doc_id", "text"), PATH).collect()
    assert len(digest) == 4
    for r in digest:
        text = {2: rows[1][1]}.get(r.doc_id, "")
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, TIK.encode_ordinary(text))).encode()).hexdigest()
    assert bpe.round_trip(df.select("doc_id", "text").limit(0), PATH).count() == 0
