"""Sinks and text sources: tag table write, CRLF export, text-file scan, lineage cut."""

import os
import tempfile

from shopgauge.operators import segments, words
from shopgauge.sources.sinks import write_lines, write_tags
from shopgauge.sources.text import read_lines
from shopgauge.plans import queries

SF = "/root/testdata/sf0.001"


def test_write_tags_is_idempotent(spark):
    tags = queries()["user_tags"](spark, SF)
    out = os.path.join(tempfile.mkdtemp(prefix="sg-tags-"), "usertag")
    write_tags(tags, out)
    write_tags(tags, out)
    back = spark.read.parquet(out)
    assert back.count() == tags.count()
    assert back.columns == tags.columns


def test_export_written_with_crlf(spark):
    df = spark.createDataFrame([(1, "a"), (2, "null")], "memberId bigint, phone string")
    out = os.path.join(tempfile.mkdtemp(prefix="sg-export-"), "member")
    write_lines(segments.export_lines(df), out)
    text = "".join(open(os.path.join(out, f), encoding="utf-8", newline="").read()
                   for f in sorted(os.listdir(out)) if f.startswith("part-"))
    assert sorted(text.split("\r\n")[:-1]) == ["[1,a]", "[2,null]"]


def test_text_file_hot_field(spark):
    folder = tempfile.mkdtemp(prefix="sg-lines-")
    with open(os.path.join(folder, "a.txt"), "w", encoding="utf-8") as fh:
        fh.write("1\ts\ten\n2\ts\tfr\n3\ts\ten\n4\tshort\n")
    lines = read_lines(spark, folder)
    got = [(r.word, r["count"]) for r in words.hot_field_top(lines, 10).collect()]
    assert got == [("en", 2), ("fr", 1)]


def test_bucketed_tag_table_joins_without_shuffle(spark):
    tags = queries()["user_tags"](spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_tags(tags, table="usertag_bucketed", buckets=4)
        t = spark.table("usertag_bucketed")
        joined = t.alias("a").join(t.alias("b"), "memberId")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text
        assert joined.count() == tags.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jobs_write_reports(spark):
    from shopgauge.plans import jobs
    out = tempfile.mkdtemp(prefix="sg-jobs-")
    for job in ("funnel", "tags", "segment"):
        jobs.run(spark, job, SF, out)
    funnel = spark.read.json(f"{out}/funnel").first().asDict()
    assert funnel["order"] >= funnel["orderAgain"] >= funnel["chargeCoupon"]
    assert abs(funnel["orderAgainRate"] - funnel["orderAgain"] / funnel["order"]) < 1e-12
    lines = spark.read.text(f"{out}/member_export").count()
    assert lines > 0


def test_members_job_writes_the_profile_document(spark):
    import json
    from shopgauge.plans import jobs
    out = tempfile.mkdtemp(prefix="sg-jobs-")
    jobs.run(spark, "members", SF, out)
    doc = json.loads(spark.read.text(f"{out}/member_profile").first()[0])
    assert set(doc) == {"memberSexes", "memberChannels", "memberMpSubs", "memberHeats"}
    assert sum(x["sexCount"] for x in doc["memberSexes"]) == spark.read.parquet(
        f"{SF}/customer.parquet").count()


def test_wide_lines_and_lone_carriage_returns(spark):
    wide = "w" * 3_000_000
    rows = [("1\ts\ten",), (f"{wide}\ta\r b\tx y",), ("short",), ("",), ("\t\t\t",), ("a\tb\t\td",)]
    out = os.path.join(tempfile.mkdtemp(prefix="sg-wide-"), "lines")
    write_lines(spark.createDataFrame(rows, "line string").coalesce(1), out)
    back = read_lines(spark, out, line_sep="\r\n")
    assert sorted(r.line for r in back.collect()) == sorted(r[0] for r in rows)
    assert {(r.word, r["count"], r.rejected) for r in words.hot_field_counts(back).collect()} == {
        ("en", 1, False), ("x y", 1, False), ("", 1, False), (None, 3, True)}
    # Without a separator a lone CR ends a line too.
    assert read_lines(spark, out).count() == 7
    empty = os.path.join(tempfile.mkdtemp(prefix="sg-wide-"), "lines")
    write_lines(spark.createDataFrame([], "line string"), empty)
    assert words.hot_field_counts(read_lines(spark, empty)).count() == 0
