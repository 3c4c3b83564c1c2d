"""What a worker of the token files holds, and the pieces that it remembers."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers

from sparkmart.llm import pretokens, tokenfiles

FILE, END = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"), 2
#: Megabytes of its own that the only worker may hold over 4 MB of 400,000 different words, its interpreter and libraries included.
MOST = 280

JOB = """
import re, sys, threading, time
from pathlib import Path
import psutil, public_tokenizers
from pyspark.sql import SparkSession
from sparkmart.llm import tokenfiles

most, ended = 0, threading.Event()
def watch():
    global most
    while not ended.wait(0.02):
        for p in psutil.Process().children(recursive=True):
            try:
                if "pyspark.daemon" in " ".join(p.cmdline()):
                    most = max(most, int(re.search(r"RssAnon:\\s+(\\d+)", Path(f"/proc/{p.pid}/status").read_text()).group(1)) >> 10)
            except (OSError, AttributeError, psutil.Error):
                pass  # it has ended

conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "1", "spark.checkpoint.dir": sys.argv[1]}
spark = SparkSession.builder.master("local[1]").config(map=conf).getOrCreate()
word = "translate(substr(sha2(concat(id, '-', i), 256), 1, 10), '0123456789', 'ghijklmnop')"
docs = spark.range(0, 1000, 1, 1).selectExpr("id AS doc_id", f"array_join(transform(sequence(1, 400), i -> {word}), ' ') AS text")
threading.Thread(target=watch, daemon=True).start()
manifest = tokenfiles.write(docs, Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(), 2, tokenfiles.folder(spark))
found = tokenfiles.read(manifest).selectExpr("count(*)", "sum(n_tokens) = sum(length(ids)) / 4").first()
ended.set()
assert tuple(found) == (1000, True), found
print("held", most)
"""


def test_a_worker_holds_little_while_every_word_is_new(tmp_path):
    root = str(Path(__file__).parents[2])
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": root}
    ran = subprocess.run([sys.executable, "-c", JOB, f"file://{tmp_path}"], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert 0 < int(ran.stdout.split()[-1]) < MOST


def ids(library, text: str) -> list[int]:
    return [*library.encode(text, add_special_tokens=False).ids, END]


def test_pieces_that_share_a_hash_or_are_forgotten_keep_their_ids(monkeypatch):
    library, remembered, _ = tokenfiles._library(FILE)
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 6)
    monkeypatch.setattr(tokenfiles, "PIECES", 2)
    texts = ["abc", "xyz", "abc", "abcd", "", "one two three four five six", "xyz abc", "one two", "a b c d e f g h i j k"]
    for clash in (False, True):
        remembered.clear()
        if clash:  # one hash for pieces of a length: texts of one piece, so that none meet in a batch
            monkeypatch.setattr(pretokens, "piece_hashes", lambda data, begin, end: (end - begin).astype(np.uint64))
            texts = ["abc", "xyz", "abc", "abcd", "wxyz", "xyz", "abcd", " abc", "x"]
        for text in texts:
            got, bounds = tokenfiles.encoded(FILE, pa.array([text]), END)
            assert (got.tolist(), bounds.tolist()) == (ids(library, text), [0, len(got)])
        assert len(remembered) <= 11
    remembered.clear()
