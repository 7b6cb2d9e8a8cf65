import pytest
from helpers import apply, plan_of, rows_of
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.catalogue import adapters
from bugtide.functions import prompts
from bugtide.operators import split, tokens
from bugtide.plans import dataset, evaluation, reports
from bugtide.sources import tables

SMALL = "/root/testdata/sf0.001"


def reports_of(spark, rows):
    return spark.createDataFrame(
        rows, "id string, source string, title string, body string, priority string, team string, report_key string"
    )


def row(body, title="Title", key="k"):
    return ("1", "tracker", title, body, "P1", "infra", key)


def test_prompt_layout(spark):
    df = reports_of(spark, [row(" body ", " Title\n"), row("", key="e"), row("\n\t ", key="w"), row(None, key="n")])
    found = {r.report_key: r for r in tokens.with_prompt_text(df).collect()}
    assert found["k"].prompt == "### Incident report:\nTitle\n\nbody\n### Triage:\n"
    for key in "ewn":
        assert found[key].prompt == "### Incident report:\nTitle\n\n### Triage:\n"
    assert found["k"].completion == "severity:P1 | team:infra"
    assert found["k"].full_text == found["k"].prompt + found["k"].completion


def test_word_tokens(spark):
    df = reports_of(spark, [row("a b c"), row("w " * 600, key="long"), row("w " * 506, key="edge")])
    found = {r.report_key: r for r in tokens.tokenise(df).collect()}
    k = found["k"]
    # ### Incident report: Title a b c ### Triage: | severity:P1 | team:infra
    assert k.prompt_length == 9 and sum(k.attention_mask) == 12
    assert [len(x) for x in (k.input_ids, k.attention_mask, k.labels)] == [512] * 3
    assert k.labels == [-100] * 9 + k.input_ids[9:]
    assert k.input_ids[12:] == [0] * 500 and 0 not in k.input_ids[:12]
    assert k.input_ids[0] == k.input_ids[7]  # the same word, the same id
    assert not k.labels_all_masked
    assert found["long"].labels == [-100] * 512 and found["long"].labels_all_masked
    assert found["edge"].labels_all_masked


def bytes_encoder():
    """A stand-in for a real tokenizer: one id per byte, and its end token is 3."""

    def encode(texts):
        return [list(t.encode()) for t in texts]

    return encode


def test_pluggable_tokenizer(spark):
    df = reports_of(spark, [row("body"), row("x" * 600, key="long")])
    out = tokens.tokenise(df, length=128, make_encoder=bytes_encoder, pad=3)
    found = {r.report_key: r for r in out.collect()}
    k = found["k"]
    full = list(k.full_text.encode())
    prompt = len(k.full_text) - len("severity:P1 | team:infra")
    assert k.input_ids == full + [3] * (128 - len(full))
    assert k.labels == [-100] * prompt + k.input_ids[prompt:]
    assert found["long"].labels == [-100] * 128


def test_pad_tokens_inside_a_prompt_are_not_counted(spark):
    out = tokens.tokenise(reports_of(spark, [row("a\x03\x03b")]), 128, bytes_encoder, pad=3)
    k = out.first()
    assert k.prompt_length == len(k.full_text) - len("severity:P1 | team:infra") - 2


def test_tokenizer_from_a_file(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    df = reports_of(spark, [row("Stack trace: naïve\n\tat x.y(Z.java:3)"), row("word " * 700, key="long"), row("", key="e")])
    out = tokens.tokenise(df, make_encoder=tokens.file_encoder(path), pad=50256)
    prompts_of = {r.report_key: r.prompt for r in tokens.with_prompt_text(df).collect()}
    for r in out.collect():
        ids = plain.encode(r.full_text).ids[:512]
        alone = len(plain.encode(prompts_of[r.report_key]).ids[:512])
        assert r.input_ids == ids + [50256] * (512 - len(ids))
        assert r.labels == [-100] * alone + r.input_ids[alone:]
        assert r.attention_mask == [1] * len(ids) + [0] * (512 - len(ids))


def test_training_sample(spark, tmp_path):
    df = reports_of(spark, [row("b", key=f"k{i:03}", title=f"t{i}") for i in range(120)])
    sample = tables.training_sample(df)
    assert sample.columns == ["input_prompt", "expected_output", "full_string"]
    assert sample.count() == 100 and sample.where(F.col("input_prompt").contains("t110")).count() == 0
    assert tables.training_sample(df, n=500).count() == 120
    tables.write_csv(sample, str(tmp_path / "sample"))
    assert rows_of(tables.read_table(spark, str(tmp_path / "sample"), "csv")) == rows_of(sample)


def test_prompt_samples_per_split(spark):
    df = reports_of(spark, [row("b", key=f"k{i}") for i in range(40)]).withColumn(
        "split", F.when(F.col("report_key") < "k15", "val").otherwise("train")
    )
    counts = {r.split: r["count"] for r in reports.sample_prompts(df).groupBy("split").count().collect()}
    assert counts == {"train": 3, "val": 3}


def test_prepare_store_tokenise_evaluate(spark, tmp_path):
    path = str(tmp_path / "splits")
    dataset.prepare_dataset(adapters.unified(spark, SMALL), path)
    stored = tables.read_splits(spark, path)
    assert set(v.PROCESSED_COLUMNS) <= set(stored.columns)
    assert stored.where("team = 'unknown'").count() == 0
    sizes = {r.split: r["count"] for r in stored.groupBy("split").count().collect()}
    quotas = split.split_quotas(
        {r.priority: r["count"] for r in stored.groupBy("priority").count().collect()}, 0.8, 0.1
    )
    assert sizes == {s: sum(q[s] for q in quotas.values()) for s in v.SPLITS}
    assert stored.select("report_key").distinct().count() == stored.count()
    assert rows_of(stored) == rows_of(split.stratified_split(adapters.with_team(spark, SMALL)).select(stored.columns))

    # Reading one split skips the folders of the others.
    one = tables.read_splits(spark, path, "val")
    assert "PartitionFilters: [isnotnull(split" in plan_of(one) or "split IN" in plan_of(one) or "(split#" in plan_of(one)
    assert one.count() == sizes["val"]
    with pytest.raises(FileNotFoundError):
        tables.read_splits(spark, path, "holdout")

    encoded = dataset.build_prompt_dataset(spark, path, str(tmp_path / "tokens"))
    again = spark.read.parquet(str(tmp_path / "tokens"))
    assert again.count() == encoded.count() == stored.count()
    wanted = ["input_ids", "attention_mask", "labels", "priority", "team", "source", "id", "full_text", "split"]
    assert set(wanted) <= set(again.columns)

    report, metrics = evaluation.evaluate_split(spark, path, "val", report_path=str(tmp_path / "report"))
    assert report.count() == metrics.first().n_samples == sizes["val"]
    from_csv = tables.read_table(spark, str(tmp_path / "report"), "csv")
    assert from_csv.columns == report.columns and from_csv.count() == sizes["val"]

    profiled = reports.profile_dataset(stored)
    assert profiled["shape"].first().rows == stored.count()
    assert sum(r.rows for r in profiled["histogram_body_words"].collect()) == stored.count()
    for table in [*profiled.values(), *reports.audit_labels(stored).values()]:
        table.collect()
    assert {r.check: r.passed for r in reports.audit_labels(stored)["checks"].collect()} == {
        "unknown_team_rate": True, "priorities_represented": True, "null_priorities": True
    }
    escalated = reports.over_escalation(adapters.tracker_raw(spark, SMALL))
    counts = escalated["counts"].first()
    assert min(50, counts.is_over_escalated) == escalated["rows"].count()


def test_build_needs_every_split(spark, tmp_path):
    df = reports_of(spark, [row("b")]).withColumn("split", F.lit("train"))
    tables.write_splits(df, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError, match="split=val"):
        dataset.build_prompt_dataset(spark, str(tmp_path / "s"))


def test_prompt_columns_are_native(spark):
    found = apply(spark, ["x"], lambda c: prompts.full_text(c, c, F.lit("P0"), F.lit("db")))
    assert found == ["### Incident report:\nx\n\nx\n### Triage:\nseverity:P0 | team:db"]
