import gzip
import random

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from siltmill.operators import charsets
from siltmill.sources import readers, sinks

TEXTS = ["Straße und Äcker, überall Flüße.", "El niño comió piña en España.", "Été, où êtes-vous, garçon ?", "plain words"]


def test_whole_texts_come_back_from_five_encodings(spark):
    names = [charsets.UTF_8, *charsets.ENCODINGS]
    rows = [(i, name, (text + " ") * (i % 7 + 1), "old") for i, (name, text) in enumerate((n, t) for n in names for t in TEXTS for _ in range(3))]
    files = spark.createDataFrame([(i, text.encode(name), old) for i, name, text, old in rows], "id int, raw binary, content string")
    got = {r.id: (r.content, r.src_encoding) for r in charsets.with_texts(files, "raw").collect()}
    assert got == {i: (text, charsets.UTF_8 if text.isascii() else name) for i, name, text, _ in rows}


def test_bytes_that_are_no_text(spark):
    rows = [(1, None), (2, b""), (3, b"a\0b"), (4, b"\xff\0"), (5, "é".encode()), (6, b"\xc3"), (7, b"\x81\x8d"), (7, b"\x81\x8d"), (None, b"x")]
    got = sorted(((r.id or 0, r.content, r.src_encoding) for r in charsets.with_texts(spark.createDataFrame(rows, "id int, raw binary"), "raw", encodings=("cp1252",)).collect()), key=str)
    want = [(1, None, None), (2, "", "utf-8"), (3, None, None), (4, None, None), (5, "é", "utf-8"), (6, "Ã", "cp1252"), (7, None, None), (7, None, None), (0, "x", "utf-8")]
    assert got == sorted(want, key=str)
    empty = charsets.with_texts(spark.createDataFrame([], "id int, raw binary"), "raw")
    assert empty.columns == ["id", "content", "src_encoding"] and empty.count() == 0


def test_pair_counts_and_choice_by_hand(spark):
    texts = spark.createDataFrame([("aé",), ("é",), (None,), ("☃a",)], "text string")
    got = {(r.encoding, r.pair): r.n for r in charsets.pair_counts(texts, "text", ("cp1252", "cp850")).collect()}
    want = {}
    for name in ("cp1252", "cp850"):
        for text in ("aé", "é", "a"):  # a snowman has no code
            raw = b"\n" + text.encode(name) + b"\n"
            for a, b in zip(raw, raw[1:], strict=False):
                want[name, a * 256 + b] = want.get((name, a * 256 + b), 0) + 1
    assert got == want
    scores = charsets.pair_scores(charsets.pair_counts(texts, "text", ("cp1252", "cp850")), ("cp1252", "cp850"))
    assert scores.shape == (65536, 2) and abs(sum(2.718281828459045 ** scores[:, 0]) - 1) < 1e-6
    assert charsets.likeliest("aé".encode("cp850"), scores, ("cp1252", "cp850")) == ("aé", "cp850")


def _sentences(seed: int, words: str) -> list[str]:
    draw = random.Random(seed)
    return [" ".join(draw.choice(words.split()) + draw.choice(["", "", "", ",", ".", "\n"]) for _ in range(40)) for _ in range(40)]


FRENCH = _sentences(1, "le café du coin elle mangé il reçu éçaille Ê du Ô garçon déçu où est pain éçai ça côté de la forêt français éçar été")
SPANISH = _sentences(2, "el niño pide ñ y otra ñ en español la es mía pequeño dueño año ñ sueño baño paño ñ")


def _read(spark, raws, parts=3):
    files = spark.createDataFrame(list(enumerate(raws)), "id int, raw binary").repartition(parts)
    return [(r.content, r.src_encoding) for r in charsets.with_texts(files, "raw").orderBy("id").collect()]


def test_bytes_that_two_encodings_can_explain(spark):
    told = [x.encode() for x in FRENCH + SPANISH]
    by_chance = "De De De éçai. éçai. éçai.\n"  # valid UTF-8 in hp_roman8
    assert by_chance.encode("hp_roman8").decode() == "De De De ŵai. ŵai. ŵai.\n"
    repeated = "il du Ê coin il pain. " * 40  # in cp850 these are ñ, which stand alone more often, but near other words
    rare = ["snow ☃ falls", "Põhja", "“so” — ‘it’ is…", "日本語の文", "😀 fine"]  # known to no other file
    files = [*told, by_chance.encode("hp_roman8"), by_chance.encode("hp_roman8"), repeated.encode("hp_roman8"), *(x.encode() for x in rare)]
    got = _read(spark, files)
    assert got[len(told) :] == [(by_chance, "hp_roman8")] * 2 + [(repeated, "hp_roman8")] + [(x, "utf-8") for x in rare]
    assert got[: len(told)] == [(x, "utf-8") for x in FRENCH + SPANISH]


def test_files_are_read_alike_alone_and_together(spark):
    known = spark.createDataFrame([(x,) for x in [*FRENCH, *SPANISH, *TEXTS, None, "", "plain"]], "text string")
    model = charsets.contexts(charsets.context_counts(known, "text"))
    assert sum(model[1]) > 50 and model[1][ord("ñ")] > model[1][ord("☃")] == 0
    raws = [(x[i:] + x[:i]).encode(name) for x in FRENCH[:5] + SPANISH[:4] for i in (0, 9, 30) for name in charsets.ENCODINGS] + [b"\x81", b"\xff", "é".encode()]
    together = charsets.read(raws, model)
    assert together == [charsets.read([x], model)[0] for x in raws]
    assert sum(x[1] == name for x, name in zip(together, charsets.ENCODINGS * 27, strict=False)) == 27 * 4
    assert charsets.read([b"\x81", b"x\x8d"], model, ("cp1252",)) == [(None, None)] * 2


def test_texts_are_encoded_as_python_does(spark):
    for name in charsets.ENCODINGS:
        text = "".join({bytes([i]).decode(name, "ignore") for i in range(1, 256)}) + "El niño, Straße"
        rows = spark.createDataFrame([(text,), ("",), (None,)], "text string").select(charsets.encoded(F.col("text"), name).alias("raw")).collect()
        assert [x.raw for x in rows] == [text.encode(name), b"", None]
        lacking = next(x for x in "☃À×" if not x.encode(name, "ignore"))
        with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
            spark.createDataFrame([(lacking,)], "text string").select(charsets.encoded(F.col("text"), name)).collect()


def test_contexts_by_hand():
    joined = [charsets._codes(x) for x in ("ab é cd é cd é", "no", "é", "Ü12 x \U0001f600")]
    of, around, words = charsets._sites(joined)
    assert of.tolist() == [0, 0, 0, 2, 3, 3]
    assert ["".join(map(chr, x)) for x in around.T] == ["b é c", "d é c", "d é\n\n", "\n\né\n\n", "\n\nÜ12", "x \uffff\n\n"]
    assert [[bool(x) for x in row] for row in words] == [[True, True, True, False, False, False], [True, True, False, False, False, False]]
    assert words[0][1] == words[0][2] == words[1][0] != words[0][0]


@pytest.mark.parametrize("parts", [1, 7])
def test_shards_hold_consecutive_rows_of_equal_bytes(spark, tmp_path, parts):
    draw = random.Random(parts)
    sizes = [draw.choice([0, 1, 5, 40, 900]) for _ in range(400)]
    df = spark.createDataFrame([(i, "x" * n if n else None) for i, n in enumerate(sizes)], "i int, t string").repartition(parts)
    n = sinks.contiguous(df, str(tmp_path / "s"), "length(t)", 2500, ["i"])
    total, start, want = sum(sizes), 0, {}
    assert n == total // 2500 + 1
    for i, size in enumerate(sizes):
        want.setdefault(f"train-{min(start * n // total, n - 1):05d}-of-{n:05d}", []).append(i)
        start += size
    back = spark.read.parquet(str(tmp_path / "s")).select("*", F.col("_metadata.row_index").alias("row"), F.col("_metadata.file_path").alias("file"))
    got, files = {}, {}
    for r in sorted(back.collect(), key=lambda r: (r.shard, r.row)):
        got.setdefault(r.shard, []).append(r.i)
        files.setdefault(r.shard, set()).add(r.file)
        assert r.t == ("x" * sizes[r.i] or None)
    assert got == want and all(len(f) == 1 for f in files.values())


def test_shards_keep_the_order_of_reading_and_odd_tables(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).selectExpr("id", "'ab' AS t", "1 AS k")
    assert sinks.contiguous(df, str(tmp_path / "a"), "length(t)", 50, prefix="x") == 5
    back = spark.read.parquet(str(tmp_path / "a")).groupBy("shard").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"))
    assert sorted((r.shard, r.a, r.b, r.n) for r in back.collect())[1:3] == [("x-00001-of-00005", 20, 39, 20), ("x-00002-of-00005", 40, 59, 20)]
    large = spark.createDataFrame([("x" * 1000,), ("y",)], "t string").coalesce(1)
    assert sinks.contiguous(large, str(tmp_path / "b"), "length(t)", 300) == 4
    assert sorted(r.shard for r in spark.read.parquet(str(tmp_path / "b")).collect()) == ["train-00000-of-00004", "train-00003-of-00004"]
    assert sinks.contiguous(df.limit(0), str(tmp_path / "c"), "length(t)", 300) == 1
    assert sinks.contiguous(df, str(tmp_path / "d"), "CAST(NULL AS INT)", 300) == 1 and spark.read.parquet(str(tmp_path / "d")).count() == 100


def test_only_named_blobs_are_opened(spark, tmp_path):
    store, seen = tmp_path / "store", tmp_path / "seen"
    seen.mkdir()
    held = spark.createDataFrame([("k1", b"hello"), ("k2", b"a\0b"), ("k4", b"never"), (None, b"x"), ("k9", None)], "id string, raw binary")
    assert sinks.blobs(held, str(store), "id", "raw") == 3 and sorted(p.name for p in store.iterdir()) == ["k1.gz", "k2.gz", "k4.gz"]
    (store / "k3.gz").write_bytes(gzip.compress(b"cut")[:-9])
    inner = readers.stored(f"file:{store}")

    def fetch(blob_id):
        (seen / blob_id).touch()
        return inner(blob_id)

    records = spark.createDataFrame([("k1", 1, "old"), ("k1", 2, None), ("k2", 3, None), ("k3", 4, None), ("k5", 5, None), (None, 6, None)], "blob_id string, n int, content string")
    got = sorted((r.n, r.content) for r in readers.fetched_blobs(records, fetch, 2).collect())
    assert got == [(1, "hello"), (2, "hello"), (3, None), (4, None), (5, None), (6, None)]
    assert sorted(p.name for p in seen.iterdir()) == ["k1", "k2", "k3", "k5"]
    assert readers.fetched_blobs(records.limit(0), fetch).count() == 0


def test_contents_of_blobs_are_neither_broadcast_nor_read_in_few_tasks(spark):
    records = spark.range(1000).select(F.col("id").cast("string").alias("blob_id"), F.lit(None).cast("string").alias("content"))
    found = readers.fetched_blobs(records, lambda _: gzip.compress(str(TaskContext.get().partitionId()).encode()))
    assert found.groupBy("content").count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
