from __future__ import annotations

import json

import numpy as np
import pytest

from annofold import sinks, sources
from annofold.operators import tables
from annofold.operators.tables import ingestion_issues, label_frequency, require_unique_ids, sequence_summary


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_fasta_both_dialects(spark, tmp_path):
    path = write(tmp_path, "a.fasta", ">sp|Q1|NAME_X OS=Thing sp OX=99 GN=g\nMAGA\n TTACA \n\n>Q2 123\nMM\r\n>Q3 x\n")
    got = [tuple(r) for r in sources.fasta(spark, path).orderBy("sequence_index").collect()]
    assert got == [
        ("Q1", "MAGATTACA", 9, "sp|Q1|NAME_X OS=Thing sp OX=99 GN=g", 0, "99", "sp", "NAME_X"),
        ("Q2", "MM", 2, "Q2 123", 1, "123", None, None),
        ("Q3", "", 0, "Q3 x", 2, None, None, None),
    ]


def test_fasta_many_splits_keep_file_order(spark, tmp_path):
    n = 3000
    path = write(tmp_path, "b.fasta", "".join(f">E{k} {k}\n{'M' * (k % 50)}\nAC\n" for k in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        read = sources.fasta(spark, path)
        got = {r["sequence_index"]: (r["entry_id"], r["length"]) for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {k: (f"E{k}", k % 50 + 2) for k in range(n)}


@pytest.mark.parametrize("text", ["ACGT\n>A 1\nM\n", ">\nACGT\n", ">sp||x\nACGT\n"])
def test_fasta_errors(spark, tmp_path, text):
    with pytest.raises(Exception, match="FASTA header|header without"):
        sources.fasta(spark, write(tmp_path, "c.fasta", text)).collect()


def test_fasta_empty(spark, tmp_path):
    assert sources.fasta(spark, write(tmp_path, "d.fasta", "")).count() == 0


def test_fasta_pipe_without_a_name(spark, tmp_path):
    got = sources.fasta(spark, write(tmp_path, "e.fasta", ">sp|Q1|\nM\n>|Q2\nM\n")).orderBy("sequence_index").collect()
    assert [(r["entry_id"], r["database"], r["uniprot_name"]) for r in got] == [("Q1", "sp", None), ("Q2", None, None)]


def test_labels(spark, tmp_path, rows):
    path = write(tmp_path, "t.tsv", "EntryID\tterm\taspect\nA\tT1\tF\nA\tT1\tF\nA\tT2\t P \nB\tT3\tC\nNA\tT3\tC\n#N/A N/A\tT3\tC\n1.#IND\tT3\tC\n-1.#QNAN\tT3\tC\n")
    labels = sources.labels_tsv(spark, path)
    assert rows(labels) == [("A", "T1", "F", "MF"), ("A", "T2", "P", "BP"), ("B", "T3", "C", "CC")]
    assert rows(label_frequency(labels), "branch", "term", "n_proteins", "n_annotations") == [("BP", "T2", 1, 1), ("CC", "T3", 1, 1), ("MF", "T1", 1, 1)]
    with pytest.raises(ValueError, match="aspect"):
        sources.labels_tsv(spark, write(tmp_path, "u.tsv", "EntryID\tterm\nA\tT1\n"))
    with pytest.raises(ValueError, match="X"):
        sources.labels_tsv(spark, write(tmp_path, "v.tsv", "EntryID\tterm\taspect\nA\tT1\tX\n"))


def test_taxonomy(spark, tmp_path, rows):
    assert rows(sources.taxonomy_tsv(spark, write(tmp_path, "x.tsv", "A\t9\nA\t9\nB\t8\n"))) == [("A", "9"), ("B", "8")]
    with pytest.raises(ValueError, match="A"):
        sources.taxonomy_tsv(spark, write(tmp_path, "y.tsv", "A\t9\nA\t8\n"))
    taxa = sources.taxon_list_tsv(spark, write(tmp_path, "z.tsv", "ID\tSpecies\n9606\tfirst\n9606\tsecond\n10090\tmouse\n"))
    assert rows(taxa) == [("10090", "mouse"), ("9606", "first")]
    tests = spark.createDataFrame([("A", "9606"), ("B", None), ("C", "7")], "entry_id string, taxon_id string")
    joined = tables.test_taxonomy(tests, taxa)
    assert rows(joined) == [("A", "9606", "first"), ("B", None, None), ("C", "7", None)]
    known = spark.createDataFrame([("A", "1"), ("X", "1")], "entry_id string, taxon_id string")
    assert rows(ingestion_issues(tests, known, joined)) == [
        ("sequence_without_taxonomy", "B"),
        ("sequence_without_taxonomy", "C"),
        ("taxonomy_without_sequence", "X"),
        ("test_entry_without_taxon", "B"),
        ("test_taxon_without_species", "7"),
    ]


def test_sequence_summary_and_guards(spark, rows):
    some = spark.createDataFrame([("A", 2), ("B", 4), ("B", 9)], "entry_id string, length int")
    assert rows(sequence_summary(some)) == [(3, 2, 2, 5.0, 4.0, 9)]
    assert rows(sequence_summary(some.limit(0))) == [(0, 0, 0, 0.0, 0.0, 0)]
    with pytest.raises(ValueError, match="B"):
        require_unique_ids(some, "sequences")


def test_hit_files(spark, tmp_path):
    seven = sources.hit_table(spark, write(tmp_path, "a.m8", "q\tt\t90\t1e-5\t50\t0.9\t0.8\n"))
    assert seven.columns == ["query_id", "target_id", "pident", "evalue", "bitscore", "qcov", "tcov"]
    twelve = sources.hit_table(spark, write(tmp_path, "b.tsv", "\t".join("abcdefghijklm") + "\n"))
    assert twelve.columns[-1] == "bitscore" and len(twelve.columns) == 12
    three = sources.hit_table(spark, write(tmp_path, "c.txt", "q\tt\t0.5\textra\n"))
    assert [tuple(r) for r in three.collect()] == [("q", "t", "0.5")]
    headed = sources.hit_table(spark, write(tmp_path, "d.tsv", "Query\tsseqid\tbits\nq\tt\t9\n"))
    assert headed.columns == ["Query", "sseqid", "bits"] and headed.count() == 1
    with pytest.raises(ValueError, match="3 columns"):
        sources.hit_table(spark, write(tmp_path, "e.tsv", "q\tt\n"))
    with pytest.raises(ValueError, match="unsupported"):
        sources.hit_table(spark, str(tmp_path / "f.xml"))


def test_tables(spark, tmp_path):
    path = write(tmp_path, "t.csv", "a,b\n1,x\n2,NA\n")
    assert dict(sources.typed_table(spark, path).dtypes)["a"] == "int"
    assert [tuple(r) for r in sources.string_table(spark, path).orderBy("a").collect()] == [("1", "x"), ("2", None)]
    sinks.write_parquet(sources.typed_table(spark, path), str(tmp_path / "p.parquet"))
    assert dict(sources.string_table(spark, str(tmp_path / "p.parquet")).dtypes) == {"a": "string", "b": "string"}


def test_raw_files(tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "x.tsv").write_text("abc")
    assert sources.copy_required_files(str(tmp_path / "in"), str(tmp_path / "raw"), ["x.tsv", "y.tsv"]) == ["x.tsv"]
    assert sources.copy_required_files(str(tmp_path / "in"), str(tmp_path / "raw"), ["x.tsv"]) == []
    report = sources.raw_file_report(str(tmp_path / "raw"), ["x.tsv", "y.tsv"])
    assert (report["present"], report["missing"], report["all_present"]) == (["x.tsv"], ["y.tsv"], False)
    assert report["files"][0]["size_bytes"] == 3
    assert "y.tsv: missing" in sources.raw_file_summary(report)
    sinks.write_json(report, str(tmp_path / "out" / "r.json"))
    text = (tmp_path / "out" / "r.json").read_text()
    assert json.loads(text) == report and text.endswith("}\n")


def test_shards_and_manifest(spark, tmp_path):
    np.save(tmp_path / "shard_00000.npy", np.array([[1, 2], [3, 4]], np.float32))
    np.save(tmp_path / "shard_00001.npy", np.array([[5, 6]], np.float32))
    got = sources.shard_vectors(spark, str(tmp_path)).orderBy("shard_path", "position").collect()
    assert [list(r["embedding"]) for r in got] == [[1, 2], [3, 4], [5, 6]]
    assert got[0]["shard_path"] == str(tmp_path / "shard_00000.npy")


def test_submission_text(spark, tmp_path):
    df = spark.createDataFrame([("P1", "T:1", 0.9), ("P1", "T:2", 0.0001), ("P1", "T:3", 1.0), ("P2", "T:1", 1e-05), ("P2", "T:2", 4e-10), ("P2", "T:3", 0.1234567890123456), ("P2", "T:4", 5e-300), ("P2", "T:5", 0.0)], "entry_id string, term string, score double")
    sinks.write_submission(df, str(tmp_path / "s"))
    lines = sorted(x for p in (tmp_path / "s").glob("part-*") for x in p.read_text().splitlines())
    assert lines == ["P1\tT:1\t0.9", "P1\tT:2\t0.0001", "P1\tT:3\t1.0", "P2\tT:1\t0.00001", "P2\tT:2\t0.0000000004", "P2\tT:3\t0.1234567890123456", "P2\tT:4\t5.0E-300", "P2\tT:5\t0.0"]
    assert sinks.write_parquet_counted(df, str(tmp_path / "p")) == 8


@pytest.mark.parametrize("block", [1, 2, 7, 50, 1000, 1 << 20])
def test_fasta_byte_ranges_of_any_size(spark, tmp_path, block):
    import gzip

    text = "\n \n>A 1\nMA\n>B 2\r\nGA\r\n\r\nTT\n>C x\n>D 4\n>\x0bE 5\n" + "".join(f">F{k} {k}\n{'MK' * (k % 5)}\n" for k in range(9))
    (tmp_path / "in").mkdir()
    write(tmp_path, "in/a.fasta", text)
    write(tmp_path, "in/b.fasta", ">G 7\nMMM" if block % 2 else ">G 7\nMMM\n")
    write(tmp_path, "in/_SUCCESS", "")
    (tmp_path / "in" / "c.fasta.gz").write_bytes(gzip.compress(b">H 8\nAC\n>I 9\nGT\n"))
    want = [("A", "MA"), ("B", "GATT"), ("C", ""), ("D", ""), ("E", ""), *((f"F{k}", "MK" * (k % 5)) for k in range(9)), ("G", "MMM"), ("H", "AC"), ("I", "GT")]
    for path in (tmp_path / "in", tmp_path / "in" / "*.fasta*"):
        got = sources.fasta(spark, str(path), block).orderBy("sequence_index").collect()
        assert [(r["entry_id"], r["sequence"]) for r in got] == want
        assert [r["sequence_index"] for r in got] == list(range(len(want)))


def test_fasta_ranges_own_records_that_begin_in_them():
    import io

    from annofold.sources.fasta_source import owned

    data = b">a\nMM\n>b\n\n>c\nACGT\nAC"
    for chunk in (1, 3, 100):
        for block in range(1, len(data) + 1):
            got = [list(owned(io.BytesIO(data), at, min(at + block, len(data)), chunk)) for at in range(0, len(data), block)]
            assert [r for part in got for r in part] == [b">a\nMM\n", b">b\n\n", b">c\nACGT\nAC"]
            for k, part in enumerate(got):
                assert all(k * block <= data.index(r[:3]) < (k + 1) * block for r in part)


def test_fasta_writes_no_text_on_the_way(spark, tmp_path):
    path = write(tmp_path, "a.fasta", ">A 1\nMA\n>B 2\nGA\n")
    plan = sources.fasta(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "sequence" not in "".join(x for x in plan.splitlines() if "FileScan parquet" in x)


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_one_ordered_submission_file(spark, tmp_path, n):
    rows = [(f"P{k % 97}", f"T:{k}", (k % 11) / 10) for k in range(n)]
    path = str(tmp_path / "out" / "s.tsv")
    for _ in range(2):  # a second file takes the place of the first
        sinks.write_submission_file(spark.createDataFrame(rows, "entry_id string, term string, score double").repartition(5), path)
        want = [f"{e}\t{t}\t{s}" for e, t, s in sorted(rows, key=lambda r: (r[0], -r[2], r[1]))]
        assert (tmp_path / "out" / "s.tsv").read_text().splitlines() == want
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == ["s.tsv"]
