"""Scans that split big files, and ids that stay the same."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from lurewatch.sources import mail as sources, records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def block_size(spark):
    """Sets how many bytes a task reads; a file is cut into blocks of so many."""
    yield lambda n: spark.conf.set(SIZE, str(n))
    spark.conf.unset(SIZE)


def hostile(path, eol, seed=3):
    rng = random.Random(seed)
    parts = ['"', ",", "\n", "\r\n", "x", "é", " ", '""', "\n\n", "y z", "\U0001f600"]

    def field():
        if rng.random() < 0.3:
            return rng.choice(["", "a", "b c", 'x"y', 'q""', "é"])
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        return '"' + text.replace('"', '""') + '"'

    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write("a,b,c" + eol)
        for _ in range(400):
            file.write(",".join(field() for _ in range(3)) + eol + (eol if rng.random() < 0.1 else ""))


def multi_line(spark, path):
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    return [tuple(r) for r in spark.read.schema(SCHEMA).options(**options).csv(str(path)).collect()]


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_blocks_of_any_size_give_the_records_of_the_multi_line_reader(spark, block_size, tmp_path, eol):
    hostile(tmp_path / "h.csv", eol)
    want = multi_line(spark, tmp_path / "h.csv")
    ids = set()
    for size in (64, 1000, 1 << 30):
        block_size(size)
        got = records.read_csv(spark, str(tmp_path / "h.csv"), SCHEMA).orderBy("record_id").collect()
        assert [tuple(r)[1:] for r in got] == want
        ids.add(tuple(r[0] for r in got))
    assert len(ids) == 1 and len(set(*ids)) == len(want)


def test_a_big_file_is_read_by_many_tasks(spark, block_size, tmp_path):
    hostile(tmp_path / "h.csv", "\n")
    block_size(1000)
    table = records.read_csv(spark, str(tmp_path / "h.csv"), SCHEMA)
    assert len({r[0] for r in table.select(F.spark_partition_id()).collect()}) > 8


def test_one_record_over_many_blocks(spark, block_size, tmp_path):
    long = "".join(f"line {i}, quoted \n" for i in range(200))
    (tmp_path / "l.csv").write_text(f'a,b,c\n1,"{long}",x\n2,y,"z"\n')
    block_size(100)
    got = records.read_csv(spark, str(tmp_path / "l.csv"), SCHEMA).orderBy("record_id").collect()
    assert [tuple(r)[1:] for r in got] == [("1", long, "x"), ("2", "y", "z")]


def test_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("a,b,c\n")
    (tmp_path / "c.csv").write_text('﻿a,b,c\n1,2,"3')
    (tmp_path / "d.csv").write_text("a,b,c\n4\n")
    got = records.read_csv(spark, str(tmp_path), SCHEMA).orderBy("record_id").collect()
    assert [tuple(r)[1:] for r in got][-1] == ("4", None, None) and len(got) == 2
    assert [r[0] // records.FILE_SPAN for r in got] == sorted({r[0] // records.FILE_SPAN for r in got})
    assert records.read_csv(spark, str(tmp_path / "b.csv"), SCHEMA).collect() == []


def test_two_scans_of_a_file_without_ids_join_one_to_one(spark, tmp_path):
    head = "subject,body,sender_display,sender_email,reply_to,spf,dkim,dmarc,attachments,has_html,num_recipients,label,family\n"
    body = "".join(f'"hi","same\nbody {i % 3}",,,,,,,,0,1,{i % 2},"account"\n' for i in range(60))
    (tmp_path / "c.csv").write_text(head + body)
    one, two = (sources.read_mail(spark, str(tmp_path / "c.csv")).repartition(k) for k in (3, 5))
    both = one.join(two.select("mail_id", F.col("body").alias("other")), "mail_id")
    assert both.count() == 60 and both.where("body <> other").count() == 0
    (tmp_path / "p.json").write_text('{"body": "a"}\n{"body": "a", "mail_id": 7}\n\n{"body": "a"}\n')
    payloads = [sorted(r.mail_id for r in sources.read_mail_json(spark, str(tmp_path / "p.json")).collect()) for _ in range(2)]
    assert payloads[0] == payloads[1] and len(set(payloads[0])) == 3 and payloads[0][-1] == 7 and payloads[0][1] < 0


def test_rows_of_a_table_without_ids_keep_theirs(spark):
    rows = [("a",)] * 5 + [("b",)] + [(None,)] * 2
    table = spark.createDataFrame(rows, "value string")
    ids = [sorted((r.mail_id, r.body) for r in sources.parse_payloads(
        table.repartition(k).select(F.to_json(F.struct(F.col("value").alias("body"))).alias("value"))).collect()) for k in (1, 4)]
    assert ids[0] == ids[1] and len({i for i, _ in ids[0]}) == 8 and all(i < 0 for i, _ in ids[0])
