"""Sources, sinks and record shapes on small fixtures (FIXTURES.md §1)."""

import gzip
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tokenmill.functions import chat
from tokenmill.operators import records as R
from tokenmill.operators import runs as U
from tokenmill.sources import io

SCHEMA = "question STRING, context STRING, answer STRING"
ROWS = [{"question": "q1", "context": "c1", "answer": "é"}, {"question": "q2", "context": "", "answer": "b"}]


def _tmp():
    return tempfile.mkdtemp(prefix="tokenmill-test-")


def test_read_jsonl_and_resolve(spark):
    d = _tmp()
    p = os.path.join(d, "train.json")
    with open(p, "w") as f:
        for r in ROWS:
            f.write(json.dumps(r) + "\n")
    df = io.read_jsonl(spark, p, SCHEMA)
    assert df.count() == 2 and df.columns == ["question", "context", "answer"]
    assert io.resolve_source(spark, p, schema=SCHEMA).count() == 2
    with pytest.raises(ValueError):
        io.resolve_source(spark, p)


def test_read_gzip_shard(spark):
    d = _tmp()
    for i in range(2):
        with gzip.open(os.path.join(d, f"part-0000{i}.json.gz"), "wt") as f:
            for r in ROWS:
                f.write(json.dumps(r) + "\n")
    one = io.read_jsonl(spark, os.path.join(d, "part-00000*.json.gz"), SCHEMA, min_partitions=4)
    assert one.count() == 2 and one.rdd.getNumPartitions() == 4


def test_write_jsonl_escapes_non_ascii(spark):
    d = _tmp()
    df = spark.createDataFrame([("é",)], "answer string")
    io.write_jsonl(df.coalesce(1), os.path.join(d, "a"), ascii=True)
    io.write_jsonl(df.coalesce(1), os.path.join(d, "b"), ascii=False)
    read = lambda p: "".join(open(os.path.join(p, f), encoding="utf-8").read()
                             for f in os.listdir(p) if f.endswith(".json"))
    assert "\\u00E9" in read(os.path.join(d, "a"))
    assert "é" in read(os.path.join(d, "b"))


def test_prepared_splits_round_trip(spark):
    d = os.path.join(_tmp(), "prepared")
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "id int, split string")
    io.write_prepared(df, d)
    assert io.read_prepared(spark, d, split="train").count() == 2
    assert sorted(r.split for r in io.read_splits(spark, d).collect()) == ["test", "train", "train"]


def test_list_file_and_pattern_filter(spark):
    d = _tmp()
    p = os.path.join(d, "layers.yaml")
    with open(p, "w") as f:
        f.write("# unfrozen parameters\n- model.layers.1.mlp\n- model.layers.2[0-9].self_attn\nother\n")
    pats = io.read_list_file(spark, p)
    assert sorted(r.entry for r in pats.collect()) == ["model.layers.1.mlp", "model.layers.2[0-9].self_attn"]
    names = spark.createDataFrame([("model.layers.1.mlp.up_proj",), ("model.layers.23.self_attn.q",),
                                   ("x.model.layers.1.mlp",), ("model.layers.3.mlp",)], "name string")
    kept = sorted(r.name for r in R.match_any_pattern(names, pats, "name").collect())
    assert kept == ["model.layers.1.mlp.up_proj", "model.layers.23.self_attn.q"]


def test_binary_files(spark):
    d = _tmp()
    with open(os.path.join(d, "a.png"), "wb") as f:
        f.write(b"\x89PNG....")
    df = io.read_images(spark, d, "*.png")
    r = df.first()
    assert r.length == 8 and bytes(r.content) == b"\x89PNG...."


def test_multimodal_messages(spark):
    df = spark.createDataFrame([("cable", "Electronics", b"img", "A cable.")],
                               "product_name string, category string, image binary, description string")
    m = R.to_multimodal_messages(df, "You write descriptions.", R.product_prompt("product_name", "category"),
                                 "image", "description").first().messages
    assert [x.role for x in m] == ["system", "user", "assistant"]
    assert m[1].content[1].type == "image" and bytes(m[1].content[1].image) == b"img"
    assert "##PRODUCT NAME##: cable" in m[1].content[0].text


def test_chat_styles(spark):
    msgs = F.array(chat.message("system", F.lit("S")), chat.message("user", F.lit("U")),
                   chat.message("assistant", F.lit(" A ")))
    r = spark.range(1).select(chat.chatml(msgs).alias("c"), chat.human_assistant(msgs).alias("h"),
                              chat.llama3_header(msgs).alias("l"),
                              chat.chatml(msgs, continue_final=True).alias("o")).first()
    assert r.c == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\n A <|im_end|>\n"
    assert r.h == "S\n\nHuman: U<eos>\n\nAssistant:  A <eos>"
    assert r.l.startswith("<|begin_of_text|><|start_header_id|>system") and r.l.endswith("assistant<|end_header_id|>\n\nA<|eot_id|>")
    assert r.o.endswith("<|im_start|>assistant\n A ")


def test_source_dispatch():
    builders = {"wikitext2": lambda: "w", "c4": lambda: "c"}
    assert U.source_dispatch("wikitext", builders, {"wikitext": "wikitext2"})() == "w"
    with pytest.raises(ValueError):
        U.source_dispatch("nope", builders, {})


def test_from_rows(spark):
    df = io.from_rows(spark, ROWS, SCHEMA)
    assert df.count() == 2
