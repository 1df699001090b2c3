"""Sources and sinks on hand-made files."""

import datetime
import io
import json
import os
import random
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tokenloom import schemas
from tokenloom.operators.chunks import pack_chunks
from tokenloom.sinks.files import save_csv, save_parquet
from tokenloom.sinks.metrics import append_metrics, save_checkpoints
from tokenloom.sinks.paths import output_path
from tokenloom.sinks.tokens import write_chunks, write_token_files, write_vocab
from tokenloom.sources import quoted_csv, ranged_text
from tokenloom.sources.archives import _runs, list_members, read_members, unzip_files
from tokenloom.sources.csv import count_extra_fields, read_csv
from tokenloom.sources.files import list_files
from tokenloom.sources.parquet import EachParquet, read_each_parquet, read_parquets
from tokenloom.sources.ranged_text import read_ranged
from tokenloom.sources.tables import read_chunks, read_ranks, read_vocab
from tokenloom.sources.text import read_text
from tokenloom.sources.token_files import check_token_files, read_token_dataset, read_token_file


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_text_newlines_and_order(spark, tmp_path):
    put(tmp_path / "b.txt", "second\rfile")
    put(tmp_path / "a.txt", "first\r\nfile\n")
    rows = read_text(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["first\nfile\n", "second\nfile"]


@pytest.mark.parametrize("seed", range(3))
def test_large_text_by_range(spark, tmp_path, seed):
    rng = random.Random(seed)
    alphabet = ["a", "bb", " ", "\n", "\r\n", "é", "😀", "　", "\n\n", "x\n", " "]
    text = "".join(rng.choices(alphabet, k=3000))
    put(tmp_path / "big.txt", text)
    put(tmp_path / "small.txt", "end")
    corpus = read_text(spark, str(tmp_path), range_bytes=rng.choice([64, 997]), piece_bytes=40)
    rows = corpus.orderBy("doc_id").collect()
    assert "".join(r["text"] for r in rows) == text.replace("\r\n", "\n") + "end"
    # A cut only falls between a visible character and a line break.
    for left, right in zip(rows, rows[1:-1]):
        assert not left["text"][-1].isspace() and right["text"][0] == "\n"


def test_lines_by_range(spark, tmp_path):
    raw = b"".join(b"%d,%s\n" % (i, b"x" * (i % 9)) for i in range(25)) + b"tail"
    path = put(tmp_path / "lines.txt", raw)
    files = list_files(spark, path)
    for size in (3, 40, 10**6):
        rows = read_ranged(spark, files, unit="line", range_bytes=size).collect()
        lines = [r["text"].encode() for r in sorted(rows, key=lambda r: r["byte_offset"])]
        assert lines == raw.split(b"\n")


def test_csv_like_quote_all(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, None, 1.5, True), (2, "", 1e7, False), (3, 'q"x', 1.25e-5, None), (4, "a\nb", None, True)],
        "i bigint, s string, d double, b boolean",
    )
    path = save_csv(df.coalesce(1), str(tmp_path), "out", timestamp=False)
    (part,) = [f for f in os.listdir(path) if f.endswith(".csv")]
    text = open(os.path.join(path, part), newline="").read()
    frame = pd.DataFrame({"i": [1, 2, 3, 4], "s": [None, "", 'q"x', "a\nb"],
                          "d": [1.5, 1e7, 1.25e-5, None], "b": [True, False, None, True]})
    want = io.StringIO()
    frame.to_csv(want, index=False, quoting=1)
    assert text == want.getvalue()


@pytest.mark.parametrize(
    "number",
    [0.1, 1.0, -2.5, 100.0, 1e6, 9999999.0, 1e7, 12345678.9, 1.5e15, 1e16, 1.25e20, 1e-3, 1e-4,
     1.5e-4, 9e-5, 1.234e-10, -1e-7, 1e100, 123456789012345.6],
)
def test_csv_numbers(spark, tmp_path, number):
    df = spark.createDataFrame([(number,)], "d double")
    path = save_csv(df, str(tmp_path), "n", timestamp=False)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert f'"{number!r}"' in lines


def test_csv_types_projection_and_missing_values(spark, tmp_path):
    path = put(tmp_path / "t.csv", "a,b,c,d,e\n1,x,1.5,True,NA\n2,NA,,False,\n")
    df = read_csv(spark, path, ["d", "c", "b", "a", "e"])
    assert df.dtypes == [("a", "bigint"), ("b", "string"), ("c", "double"), ("d", "boolean"),
                         ("e", "double")]
    assert [tuple(r) for r in df.orderBy("a").collect()] == [
        (1, "x", 1.5, True, None), (2, None, None, False, None)]
    with pytest.raises(ValueError, match="not in the CSV header"):
        read_csv(spark, path, ["a", "z"])
    typed = read_csv(spark, path, ["a"], schema="a string")
    assert typed.dtypes == [("a", "string")]
    put(tmp_path / "s.csv", "a;b\n1;2\n")
    assert tuple(read_csv(spark, str(tmp_path / "s.csv"), ["b"], ";").first()) == (2,)


@pytest.mark.parametrize("multiline", [False, True])
def test_csv_shift_jis(spark, tmp_path, multiline):
    cell = '"一\n二"' if multiline else "一二"
    data = f"名,n\n表,1\n{cell},2\n".encode("shift_jis") + b"\x81,3\n"
    path = put(tmp_path / "j.csv", data)
    rows = read_csv(spark, path, ["名", "n"])
    assert rows.columns == ["名", "n"]
    got = [tuple(r) for r in rows.orderBy("n").collect()]
    assert got[:2] == [("表", 1), ("一\n二" if multiline else "一二", 2)]
    decoded = pd.read_csv(io.StringIO(data.decode("shift_jis", "ignore")))
    assert len(got) == len(decoded)


def test_csv_mixed_encodings(spark, tmp_path):
    put(tmp_path / "u.csv", "k,v\né,1\n")
    put(tmp_path / "j.csv", "k,v\n表,2\n".encode("shift_jis"))
    put(tmp_path / "q.csv", 'k,v\n"a\nb",3\n')
    rows = read_csv(spark, str(tmp_path), ["k", "v"]).orderBy("v").collect()
    assert [tuple(r) for r in rows] == [("é", 1), ("表", 2), ("a\nb", 3)]


def records_of(data, delimiter=","):
    """Records by one look at every byte, with a state per character."""
    out, record, state, i = [], "", "start", 0
    while i < len(data):
        c = data[i]
        if state == "inside":
            state = "closed" if c == '"' else state
        elif state in ("start", "closed") and c == '"':
            state = "inside"
        elif c == "\n":
            out.append(record.removesuffix("\r"))
            record, state = "", "start"
            i += 1
            continue
        elif data.startswith(delimiter, i):
            record, state = record + delimiter, "start"
            i += len(delimiter)
            continue
        else:
            state = "field"
        record += c
        i += 1
    return [r for r in [*out, record][1:] if r]


@pytest.mark.parametrize("delimiter", [",", "||"])
@pytest.mark.parametrize("seed", range(4))
def test_quoted_ranges_meet_at_the_same_records(tmp_path, monkeypatch, seed, delimiter):
    monkeypatch.setattr(quoted_csv, "READ_BYTES", 7)
    rng = random.Random(seed)
    parts = ['"', '""', '"""', delimiter, "\n", "\r\n", "é", "x y", f'{delimiter}"', f'"{delimiter}', '"\n']
    data = "a,b\n" + "".join(rng.choices(parts, k=400))
    path, raw, mark = put(tmp_path / "q.csv", data), data.encode(), delimiter.encode()
    for size in (1, 2, 5, 17, 100, 10**6):
        inside, found = False, []
        for start in range(0, len(raw), size):
            stop = min(start + size, len(raw))
            found += quoted_csv.range_records(path, start, stop, mark, inside)
            inside = quoted_csv.range_function(path, start, stop, mark)[inside]
        assert [r.decode() for _, r in found if r][1:] == records_of(data, delimiter), size


@pytest.mark.parametrize("encoding", ["utf-8", "shift_jis"])
def test_quoted_files_are_read_by_several_tasks(spark, tmp_path, encoding):
    rng = random.Random(1)
    words = ["plain", 'with "quotes"', "line\nbreak", "表,二", "", " pad ", "\n\n", '"', "a\r\nb"]
    rows = [(str(i), rng.choice(words), rng.choice(words)) for i in range(700)]
    out = io.StringIO()
    pd.DataFrame(rows, columns=["k", "v", "w"]).to_csv(out, index=False)
    path = put(tmp_path / "q" / "a.csv", out.getvalue().encode(encoding))
    put(tmp_path / "q" / "b.csv", 'w,v,k\n"x\ny",2,1000\n')
    put(tmp_path / "q" / "c.csv", "")
    want = sorted([*((int(k), v or None, w or None) for k, v, w in rows), (1000, "2", "x\ny")])
    for size in (50, 1000, 1 << 20):
        df = read_csv(spark, str(tmp_path / "q"), ["k", "v", "w"], range_bytes=size)
        assert sorted(map(tuple, df.collect())) == want
    records = quoted_csv.read_records(spark, [path], ",", "latin-1", 1000)
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 8 and records.count() == 700


def test_states_of_ranges_compose_along_a_file(spark):
    rng = random.Random(2)
    functions = [(False, False), (True, True), (True, False), (False, True)]
    rows, want = [], {}
    for path in ("x", "y"):
        inside = False
        for i in range(60):
            f = rng.choice(functions if rng.random() < 0.3 else functions[2:])
            rows.append((path, i, i + 1, *f))
            want[path, i] = inside
            inside = f[inside]
    df = spark.createDataFrame(rows, f"{quoted_csv.RANGES}, from_outside boolean, from_inside boolean")
    found = {(r["path"], r["start"]): r["inside"] for r in quoted_csv.start_states(df).collect()}
    assert found == want


def make_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, data in members:
            archive.writestr(name, data)
    return str(path)


def test_zip(spark, tmp_path):
    big = os.urandom(1000) * 30
    path = make_zip(tmp_path / "in" / "x.zip", [("a.csv", b"1"), ("d/", b""), ("d/b.csv", big), ("e", b"")])
    names = list_members(spark, path).orderBy("ordinal").collect()
    assert [r["member"] for r in names] == ["a.csv", "d/", "d/b.csv", "e"]
    parts = read_members(spark, path, part_bytes=7000).orderBy("ordinal", "part").collect()
    assert b"".join(bytes(r["content"]) for r in parts if r["member"] == "d/b.csv") == big
    assert max(len(r["content"]) for r in parts) <= 7000
    assert {r["member"] for r in parts} == {"a.csv", "d/", "d/b.csv", "e"}
    out = tmp_path / "out"
    listed = unzip_files(spark, path, str(out))
    assert {r["member"] for r in listed.collect()} == {"a.csv", "d/b.csv", "e"}
    assert (out / "d" / "b.csv").read_bytes() == big and (out / "a.csv").read_bytes() == b"1"
    assert sorted(os.listdir(out)) == ["a.csv", "d", "e"]


def test_zip_refuses_clashes_and_escapes(spark, tmp_path):
    make_zip(tmp_path / "z" / "1.zip", [("a", b"1")])
    make_zip(tmp_path / "z" / "2.zip", [("a", b"2")])
    with pytest.raises(ValueError, match="named"):
        unzip_files(spark, str(tmp_path / "z"), str(tmp_path / "o"))
    evil = make_zip(tmp_path / "evil.zip", [("../x", b"1")])
    with pytest.raises(Exception, match="leaves the target"):
        unzip_files(spark, evil, str(tmp_path / "o"))


def test_parquet_glob(spark, tmp_path):
    save_parquet(spark.range(3).coalesce(1), str(tmp_path), "a", timestamp=False)
    save_parquet(
        spark.range(2).withColumn("x", F.lit("y")).coalesce(1), str(tmp_path), "b", timestamp=False
    )
    rows = read_parquets(spark, f"{tmp_path}/*/*.parquet")
    counts = rows.groupBy("file_path").agg(F.count("*").alias("n"), F.count("x").alias("x")).collect()
    assert sorted((r["n"], r["x"]) for r in counts) == [(2, 2), (3, 0)]
    assert [f.count() for f in read_each_parquet(spark, f"{tmp_path}/*/*.parquet")] == [3, 2]


def test_output_path():
    now = datetime.datetime(2023, 4, 5, 6, 7)
    assert output_path("x/", "f.csv", now=now) == "x/20230405-0607_f.csv"
    assert output_path("x", "f.csv", timestamp=False) == "x/f.csv"


def test_token_file_of_one_stream(spark, tmp_path):
    ids = np.random.default_rng(0).integers(0, 65536, 100_003).astype("<u2")
    path = put(tmp_path / "train.bin", ids.tobytes())
    df = read_token_file(spark, path, chunk_size=64, range_ids=30_000)
    assert df.rdd.getNumPartitions() == 4
    rows = df.orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in rows] == list(range(len(rows)))
    assert [t for r in rows for t in r["tokens"]] == ids.tolist()
    put(tmp_path / "odd.bin", b"123")
    with pytest.raises(Exception, match="16-bit"):
        read_token_file(spark, str(tmp_path / "odd.bin"), chunk_size=4).collect()
    with pytest.raises(Exception):
        read_token_file(spark, str(tmp_path / "none.bin"), chunk_size=4).collect()


def test_token_files_and_chunks(spark, tmp_path):
    rng = random.Random(0)
    rows = [(s, i, [rng.randrange(65536) for _ in range(10 if i < 99 else 3)])
            for s in ("train", "val") for i in range(100)]
    chunks = spark.createDataFrame(rows, schemas.TOKEN_CHUNKS)
    stored = read_chunks(spark, write_chunks(chunks, str(tmp_path / "chunks")))
    folder = write_token_files(stored, str(tmp_path / "bin"), chunk_size=10)
    for split in ("train", "val"):
        names = sorted(n for n in os.listdir(tmp_path / "bin" / split) if n.endswith(".bin"))
        raw = b"".join((tmp_path / "bin" / split / n).read_bytes() for n in names)
        want = [t for s, _, ts in rows if s == split for t in ts]
        assert np.frombuffer(raw, "<u2").tolist() == want
    back = read_token_dataset(spark, folder, chunk_size=10)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
    plan = read_chunks(spark, str(tmp_path / "chunks"), "val")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    bad = spark.createDataFrame([("train", 0, [65536])], schemas.TOKEN_CHUNKS)
    with pytest.raises(Exception, match="16 bits"):
        write_token_files(bad, str(tmp_path / "bad"), chunk_size=1)


def test_token_stream_with_a_gap_is_refused(spark, tmp_path):
    rows = [("train", i, [i] * 10) for i in range(20)]
    chunks = spark.createDataFrame(rows, schemas.TOKEN_CHUNKS)
    with pytest.raises(Exception, match="should start at id 100"):
        write_token_files(chunks.filter("chunk_id < 10 or chunk_id >= 15"), str(tmp_path / "gap"), chunk_size=10)
    with pytest.raises(Exception, match="no write to it was completed"):
        read_token_file(spark, str(tmp_path / "gap" / "train"), chunk_size=10).collect()
    write_token_files(chunks, str(tmp_path / "0"), chunk_size=10)
    with pytest.raises(FileExistsError):
        write_token_files(chunks, str(tmp_path / "0"), chunk_size=10)


def test_a_token_stream_is_what_its_manifest_names(spark, tmp_path):
    rows = [("train", i, [i] * 10) for i in range(64)]
    chunks = spark.createDataFrame(rows, schemas.TOKEN_CHUNKS).repartitionByRange(8, "chunk_id")
    write_token_files(chunks, str(tmp_path), chunk_size=10, ordered=True)
    folder = tmp_path / "train"
    files = sorted(n for n in os.listdir(folder) if n.endswith(".bin"))
    assert len(files) > 4
    whole = {n: (folder / n).read_bytes() for n in files}

    def read():
        return sorted(tuple(r) for r in read_token_file(spark, str(folder), chunk_size=10).collect())

    assert read() == [(i, [i] * 10) for i in range(64)]
    (folder / f"{640:018d}-leftover.bin").write_bytes(b"12" * 10)  # of an attempt that failed
    assert len(read()) == 64
    last = folder / files[-1]
    last.unlink()
    with pytest.raises(Exception, match="should hold"):
        read()
    last.write_bytes(whole[files[-1]][:-2])
    with pytest.raises(Exception, match="should hold"):
        read()
    last.write_bytes(whole[files[-1]][:-2] + b"zz")
    with pytest.raises(Exception, match="not the file"):
        read()
    assert sorted(r["intact"] for r in check_token_files(spark, str(folder)).collect()) == [False] + [True] * (len(files) - 1)
    last.write_bytes(whole[files[-1]])
    assert len(read()) == 64
    (folder / "_manifest.parquet").unlink()
    with pytest.raises(Exception, match="no write to it was completed"):
        read()


def test_ordered_chunks_are_written_without_a_shuffle(spark, tmp_path):
    docs = spark.createDataFrame(
        [("train" if i < 90 else "val", i, 37, [i] * 37) for i in range(100)],
        "split string, doc_id bigint, n_tokens bigint, tokens array<int>",
    )
    path = write_chunks(pack_chunks(docs, 8, tokens_per_shard=256), str(tmp_path / "chunks"))
    stored = read_chunks(spark, path, "train").select("chunk_id", "tokens")
    # Every stored file is one run of whole shards in order.
    for name in (tmp_path / "chunks" / "split=train").glob("*.parquet"):
        ids = [r["chunk_id"] for r in spark.read.parquet(str(name)).collect()]
        assert ids == sorted(ids) and sum(b - a != 1 for a, b in zip(ids, ids[1:])) <= len(ids) // 32
    write_token_files(read_chunks(spark, path), str(tmp_path / "bin"), chunk_size=8, ordered=True)
    back = read_token_file(spark, str(tmp_path / "bin" / "train"), chunk_size=8)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, stored.collect()))
    raw = [t for r in back.orderBy("chunk_id").collect() for t in r["tokens"]]
    assert raw == [i for i in range(90) for _ in range(37)]


def test_csv_headers_in_different_orders(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "b.csv", "y,x\n3,30\n")
    rows = read_csv(spark, str(tmp_path), ["x", "y"])
    assert rows.columns == ["x", "y"]
    assert sorted(map(tuple, rows.collect())) == [(1, 2), (30, 3)]
    put(tmp_path / "c.csv", "x,z\n1,2\n")
    with pytest.raises(ValueError, match="other columns"):
        read_csv(spark, str(tmp_path), ["x"])


def test_csv_integers_with_gaps_stay_integers(spark, tmp_path):
    path = put(tmp_path / "g.csv", "k,n\na,9007199254740993\nb,\nc,NA\n")
    rows = read_csv(spark, path, ["k", "n"])
    assert dict(rows.dtypes)["n"] == "bigint"
    assert {r["k"]: r["n"] for r in rows.collect()} == {"a": 9007199254740993, "b": None, "c": None}


def test_csv_fields_beyond_the_header(spark, tmp_path):
    path = put(tmp_path / "e.csv", "x,y\n1,10\n2,20,99\n3\n")
    rows = read_csv(spark, path, ["x", "y"]).orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(1, 10), (2, 20), (3, None)]
    with pytest.raises(Exception, match="more fields than its header"):
        read_csv(spark, path, ["x", "y"], extra_fields="fail").collect()
    assert [r["rows"] for r in count_extra_fields(spark, path).collect()] == [1]


def test_zip_names_that_meet_are_refused(spark, tmp_path):
    path = make_zip(tmp_path / "in" / "x.zip", [("d/b.csv", b"1"), ("d/./b.csv", b"2")])
    with pytest.raises(ValueError, match="are named 'd/b.csv'"):
        unzip_files(spark, path, str(tmp_path / "out"))


def test_zip_members_are_divided_by_bytes(spark, tmp_path):
    assert _runs([1, 2, 3]) == [0, 0, 0]
    big = 1 << 27
    assert _runs([5, big, 7, 8, big, big]) == [0, 1, 2, 2, 3, 4]
    for k in range(8):
        make_zip(tmp_path / "in" / f"{k}.zip", [(f"{i}.txt", b"x") for i in range(60)])
    parts = read_members(spark, str(tmp_path / "in" / "*.zip"))
    tasks = parts.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts.count() == 480 and tasks > 3


def test_text_without_line_ends_is_cut_in_bounded_pieces(spark, tmp_path):
    text = "é" * 40_000 + "\n" + "plain words " * 3000 + "x" * 50_000
    path = put(tmp_path / "long.txt", text.encode())
    files = [(path, len(text.encode()))]
    for size in (3000, 16_000, 1 << 20):
        rows = read_ranged(spark, files, unit="piece", range_bytes=size, piece_bytes=1000).collect()
        rows.sort(key=lambda r: r["byte_offset"])
        assert "".join(r["text"] for r in rows) == text
        assert max(len(r["text"].encode()) for r in rows) <= 10_000
        if size == 3000:
            first = [r["byte_offset"] for r in rows]
    again = read_ranged(spark, files, unit="piece", range_bytes=8000, piece_bytes=1000).collect()
    assert max(len(r["text"].encode()) for r in again) <= 10_000 and first[0] == 0


def test_bad_bytes_are_an_error_in_files_of_any_size(spark, tmp_path):
    path = put(tmp_path / "bad.txt", b"good\n\xff\xfe bad\n")
    for limit in (1, 1 << 20):
        with pytest.raises(Exception):
            read_text(spark, path, piece_bytes=limit).collect()


def test_text_files_are_planned_with_their_positions(spark, tmp_path):
    texts = {f"{i:03d}.txt": f"file {i}\nend" * (i % 4) for i in range(300)} | {"150.txt": "long line\n" * 5000}
    for name, text in texts.items():
        put(tmp_path / name, text)
    corpus = read_text(spark, str(tmp_path), range_bytes=4000, piece_bytes=500)
    plan = corpus._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    rows = corpus.orderBy("doc_id").collect()
    assert "".join(r["text"] for r in rows) == "".join(texts[n] for n in sorted(texts))
    assert len({r["doc_id"] for r in rows}) == len(rows)
    reader = ranged_text.RangedTextReader({"files": json.dumps([["x", 10]] * 100_000), "file_bits": "4"})
    planned = reader.partitions()
    assert len(planned) == 1 and planned[0].ranges[-1].first == 99_999 << 4


def test_frames_of_single_files_are_made_when_asked_for(spark, tmp_path, monkeypatch):
    spark.range(40).repartition(8).write.parquet(str(tmp_path / "p"))
    files = read_each_parquet(spark, f"{tmp_path}/p/*.parquet")
    many = EachParquet(spark, files.paths * 2000)
    assert len(many) == 2000 * len(files) >= 10_000
    assert sum(f.count() for f in files) == 40 and many[-1].count() == files[-1].count()
    rest = files[2:]
    assert rest.rows().count() == sum(f.count() for f in rest)
    assert rest.rows().select("file_path").distinct().count() == len(rest)


def test_vocab_and_ranks(spark, tmp_path):
    path = str(tmp_path / "vocab")
    assert read_vocab(spark, path).count() == 0
    write_vocab(spark.createDataFrame([(0, "a")], schemas.VOCAB), path)
    assert [tuple(r) for r in read_vocab(spark, path).collect()] == [(0, "a")]
    put(tmp_path / "ranks.txt", "YQ== 0\nIHRoZQ== 1\n")
    ranks = {bytes(r["token"]): r["rank"] for r in read_ranks(spark, str(tmp_path / "ranks.txt")).collect()}
    assert ranks == {b"a": 0, b" the": 1}


def test_metrics_and_checkpoints(spark, tmp_path):
    log = spark.createDataFrame(
        [("r", i * 250, v) for i, v in enumerate([5.0, 4.0, 4.0, 3.0])],
        "run_id string, iter bigint, val_loss double",
    )
    path = append_metrics(log, str(tmp_path / "m"))
    append_metrics(log, path)
    assert spark.read.parquet(path).count() == 8
    records = spark.read.parquet(save_checkpoints(log, str(tmp_path / "c"), "runs/"))
    assert sorted(tuple(r) for r in records.collect()) == [
        ("r", 250, 4.0, "runs/r/iter-250"), ("r", 750, 3.0, "runs/r/iter-750")]


def test_small_ranges_share_tasks_and_read_little(tmp_path, monkeypatch):
    from tokenloom.sources import ranged_text

    path = tmp_path / "x.txt"
    path.write_bytes(b"0123456789abcde\n" * (1 << 16))
    options = {"files": json.dumps([[str(path), 1 << 20]]), "range_bytes": str(1 << 10), "piece_bytes": "100"}
    reader = ranged_text.RangedTextReader(options)
    planned = reader.partitions()
    assert sum(len(p.ranges) for p in planned) == 1024 and len(planned) == 64
    asked, resolve = [], ranged_text.resolve

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read(self, n):
            asked.append(n)
            return self.file.read(n)

        def __getattr__(self, name):
            return getattr(self.file, name)

    class Files:
        def open_input_file(self, name):
            return Counted(resolve(name)[0].open_input_file(name))

    monkeypatch.setattr(ranged_text, "resolve", lambda name: (Files(), name))
    text = "".join(t for p in planned for b in reader.read(p) for t in b.column("text").to_pylist())
    assert text == "0123456789abcde\n" * (1 << 16) and max(asked) < 1 << 17


def test_many_small_members_take_few_tasks(spark, tmp_path):
    import zipfile

    from tokenloom.sources.archives import _listed, _spread, read_extracted, unzip_files

    for k in range(40):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w") as archive:
            for i in range(100):
                archive.writestr(f"d{k}/{i}.txt", f"{k} é {i}")
    glob, target = str(tmp_path / "*.zip"), str(tmp_path / "out")
    assert _spread(_listed(spark, glob)).rdd.getNumPartitions() == 16
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    files = read_extracted(unzip_files(spark, glob, target), target)
    assert "binaryFile" not in files._jdf.queryExecution().toString()
    rows = {r["member"]: bytes(r["content"]).decode() for r in files.collect()}
    assert rows == {f"d{k}/{i}.txt": f"{k} é {i}" for k in range(40) for i in range(100)}
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
