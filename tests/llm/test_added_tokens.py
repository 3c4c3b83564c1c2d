"""Texts with the names of added tokens against the public library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers

from sparkmart.llm import tokenfiles


def test_added_tokens_are_those_of_the_library(spark):
    from tokenizers import AddedToken, Tokenizer

    file = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    more = Tokenizer.from_str(file)
    more.add_tokens([AddedToken("<x y>", lstrip=True, rstrip=True), AddedToken("word", single_word=True)])
    texts = ["a <|endoftext|> b", "plain words", "<|endoftext|>", "", "a<|endoftext|><|endoftext|>\n\n b", "<|endoftext", "a  <x y>  b", "words word é word", "last"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for content in (file, more.to_str()):
        library, at = Tokenizer.from_str(content), 0
        got = tokenfiles.read(tokenfiles.write(docs, content, 2, tokenfiles.folder(spark))).orderBy("doc_id").collect()
        for text, r in zip(texts, got, strict=True):
            ids = [*library.encode(text, add_special_tokens=False).ids, 2]
            assert (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)
