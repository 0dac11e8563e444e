"""Files of token ids: round trips against the tokenizer library, access to single documents, broken files."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_tokens import odd_texts
from tokenizers import Tokenizer

from stationloom.llm.idfiles import fetch_ids, read_ids, write_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    texts = odd_texts(300)
    out = list(enumerate(texts)) + [(None, "no id"), (None, None), (7, "twice"), (7, "twice"), (-5, "below"), (9000, "one two three " * 60_000)]
    random.Random(4).shuffle(out)
    return out


def expected(rows):
    library, out, before = Tokenizer.from_file(PATH), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, before, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), ids))
        before += len(ids)
    return out


@pytest.mark.parametrize("shard_bytes", [500, 1 << 30])
def test_round_trip(spark, tmp_path, rows, shard_bytes):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("frame", F.lit("clash")).withColumn("place", F.lit(1)).repartition(3)
    folder = f"file:{tmp_path}/ids"
    write_ids(docs, PATH, folder, shard_bytes=shard_bytes)
    found = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], list(r["ids"])) for r in read_ids(spark, folder, with_ids=True).collect()]
    wanted = expected(rows)
    # rows of one id may come in either order
    assert sorted((f[0] is None, f[0] or 0, f[2:]) for f in found) == sorted((f[0] is None, f[0] or 0, f[2:]) for f in wanted)
    found.sort(key=lambda r: r[1])
    assert [f[0] for f in found] == [w[0] for w in wanted]
    assert [f[1] for f in found] == np.cumsum([0] + [f[2] for f in found]).tolist()[:-1]
    got = fetch_ids(spark, folder, [7, 9000, -5, 12, 123456]).collect()
    assert sorted((r["doc_id"], r["start"], list(r["ids"])) for r in got) == sorted((f[0], f[1], f[4]) for f in found if f[0] in (7, 9000, -5, 12))
    shards = list((tmp_path / "ids").glob("shard-*.ids"))
    assert (len(shards) > 5) == (shard_bytes == 500)
    assert fetch_ids(spark, folder, []).count() == 0 and fetch_ids(spark, folder, [123456]).count() == 0


def test_dictionary_helps_and_is_checked(spark, tmp_path):
    rng = random.Random(1)
    phrases = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) for _ in range(12)) for _ in range(30)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(phrases) for _ in range(6))) for i in range(600)], "doc_id long, text string")
    write_ids(docs, PATH, f"{tmp_path}/with")
    write_ids(docs, PATH, f"{tmp_path}/without", sample_docs=0)
    size = {k: sum(p.stat().st_size for p in (tmp_path / k).glob("shard-*.ids")) for k in ("with", "without")}
    assert (tmp_path / "with" / "dictionary").stat().st_size > 0 and size["with"] < 0.7 * size["without"]
    assert read_ids(spark, f"{tmp_path}/without").count() == 600
    (tmp_path / "without" / "dictionary").write_bytes((tmp_path / "with" / "dictionary").read_bytes())
    with pytest.raises(Exception, match="another dictionary"):
        read_ids(spark, f"{tmp_path}/without").count()
    shard = next((tmp_path / "with").glob("shard-*.ids"))
    shard.write_bytes(shard.read_bytes()[:-40] + b"x" * 40)
    with pytest.raises(Exception, match="no whole file"):
        read_ids(spark, f"{tmp_path}/with").count()


def test_files_of_lost_tasks_are_ignored(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    write_ids(docs, PATH, f"{tmp_path}/ids")
    (tmp_path / "ids" / "shard-lost.ids").write_bytes(b"half a file")
    assert sorted(r["doc_id"] for r in read_ids(spark, f"{tmp_path}/ids").collect()) == [1, 2]


def test_empty(spark, tmp_path):
    write_ids(spark.createDataFrame([], "doc_id long, text string"), PATH, f"{tmp_path}/ids")
    assert read_ids(spark, f"{tmp_path}/ids").count() == 0
