"""Blocks that begin anywhere in the token stream, against the whole stream in plain Python."""

import hashlib
import random
import re

from sievemark.operators import token_stream


def test_blocks_are_cut_from_the_whole_stream(spark):
    r = random.Random(4)
    texts = ["", None, "one", "long " * 9000, *[" ".join(f"t{r.randint(0, 50)}" for _ in range(r.randint(0, 40))) for _ in range(40)]]
    rows = [(v, f"d{i}", t) for v in ("a", "b") for i, t in enumerate(texts) if v == "a" or i < 20] + [("tiny", "d0", "two words")]
    docs = spark.createDataFrame(rows, "variant string, id string, text string").repartition(5)
    offsets = token_stream.document_offsets(docs)
    for block, n in ((3, 200), (50, 40)):
        got = {(x.variant, x.draw_id): x for x in token_stream.sample_batches(docs, offsets, n, block).collect()}
        want = {}
        for v in ("a", "b"):
            stream = []
            for _, d, t in sorted((x for x in rows if x[0] == v), key=lambda x: hashlib.md5(f"1234:{x[1]}".encode()).hexdigest()):
                stream += [*re.findall(r"[a-z0-9]+", t or ""), token_stream.END]
            for i in range(n):
                start = int(hashlib.md5(f"1337:{v}:{i}".encode()).hexdigest()[:15], 16) % (len(stream) - block - 1)
                want[v, i] = (start, stream[start : start + block], stream[start + 1 : start + block + 1])
        assert {k: (x.start, x.x, x.y) for k, x in got.items()} == want


def test_streams_without_room_and_empty_tables(spark):
    docs = spark.createDataFrame([("v", "a", "one two")], "variant string, id string, text string")
    offsets = token_stream.document_offsets(docs)
    assert token_stream.sample_batches(docs, offsets, 5, 2).collect() == []
    assert len(token_stream.sample_batches(docs, offsets, 5, 1).collect()) == 5
    none = docs.limit(0)
    assert token_stream.sample_batches(none, token_stream.document_offsets(none), 5, 2).collect() == []
