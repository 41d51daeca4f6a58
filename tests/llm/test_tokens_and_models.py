"""Token files, packing, quality, tool calls and the pipeline."""

import json
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from plain_steps import hit_words, similar
from tripstrata.llm import packing as pk
from tripstrata.llm import quality as ql
from tripstrata.llm import token_files as tf
from tripstrata.llm import tool_calls as tc
from tripstrata.llm.queries import QUERIES, tokenizer
from tripstrata.llm.tokens import Encoder

DOCS = "doc_id long, text string, start int, length string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def some_texts():
    rnd = random.Random(2)
    pieces = [*"aAbZé ÉßΣσİ'’s.!,…\x1ć \t\n9²一½ſK-–", "<|endoftext|>", "<|ENDOFTEXT|>", "it's", "we'll", "word", "Ünder"]
    return [None, "", " ", "word " * 3000, "x" * 20_000] + [
        "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]


def test_encoder_equals_library(library):
    own = Encoder(tokenizer())
    assert own.by_word
    for text in some_texts():
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == library.encode(
            text or "", add_special_tokens=False).ids, text


def test_token_files_round_trip(spark, library):
    texts = some_texts()[:300]
    rows = [(5 * i - 40, t, i, "x") for i, t in enumerate(texts)] + [(None, "null key", 0, None), (0, "key twice", 0, "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    folder = tf.new_folder(docs)
    manifest = tf.write_tokens(docs, tokenizer(), folder)
    got = [tuple(r) for r in tf.read_tokens(manifest, folder).orderBy("start").collect()]
    at, want = 0, []
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    texts_of = {k: sorted(t or "" for q, t, *_ in rows if q == k) for k in {r[0] for r in rows}}
    for k, start, n, c in got:
        ids = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts_of[k]]
        assert start == at and any(len(i) == n and crc(i) == c for i in ids)
        want.append(c)
        at += n
    empty = tf.new_folder(docs)
    assert tf.read_tokens(tf.write_tokens(docs.limit(0), tokenizer(), empty), empty).count() == 0


def test_packing_is_whole_and_tight(spark, library):
    rnd = random.Random(4)
    texts = [None, "", "word " * 9000, "word " * 4095, "word " * 4096] + ["word " * int(rnd.paretovariate(0.7) * 40) for _ in range(900)]
    texts = [t if t is None else t[:5 * 12_000] for t in texts]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(3, "word", 0, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = pk.pack_documents(docs, tokenizer(), group=300).toPandas()
    want = []
    for k, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(k, n, a, len(ids[a:a + 4096]), crc(ids[a:a + 4096])) for n, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1].tolist()] and own["length"].sum() <= 4096
    least = -(-got["length"].sum() // 4096)
    assert got["sequence_id"].nunique() <= least * 1.02 + 5
    assert pk.pack_documents(docs.limit(0), tokenizer()).count() == 0


def test_best_two_replace_the_smallest():
    assert sorted(map(sorted, pk.pack(np.array([60, 30, 25, 13]), 100, small_part=101))) == [[13, 25, 60], [30]]
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 4097, 3000)
    bins = pk.pack(lengths)
    assert sorted(x for b in bins for x in b) == sorted(lengths.tolist()) and max(map(sum, bins)) <= 4096
    room = []  # best fit in falling order
    for x in sorted(lengths.tolist(), reverse=True):
        fits = [r for r in room if r >= x]
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else 4096) - x)
    assert len(bins) <= len(room)


def test_statistics_of_odd_texts(spark):
    texts = [None, "", " ", "A", "word " * 50_000, "x" * 300_000, "é" * 10, "\x00\x01", "THE!! THE!!", "a | b | c"]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r.x for r in ql.statistics(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == len(texts) and all(np.isfinite(x).all() and len(x) == len(ql.NAMES) for x in got.values())
    assert got[0] == got[1] and got[8][ql.NAMES.index("repeated_next")] == pytest.approx(0.5 ** 0.5)
    assert got[4][0] == pytest.approx(np.log1p(50_000)) and got[6][1] == pytest.approx(np.log1p(10))


def test_quality_on_held_out_labels(spark, sf):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_quality"](spark, sf).toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    rows = pq.read_table(f"{sf}/labels.parquet").to_pandas().merge(got, on="doc_id")
    test = rows[rows["held_out"]]
    assert (test["predicted"] == test["quality"]).mean() >= 0.97


def test_quality_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a", 0, ""), (2, None, 0, ""), (1, "a", 0, "")], DOCS)
    stats = ql.statistics(docs)
    for rows, want in (([(1, 1, 0)], 1.0), ([], 0.5), ([(1, None, 0), (2, 7, 0)], 0.5)):
        model = ql.fit(stats, spark.createDataFrame(rows, "doc_id long, quality int, x int"))
        assert {r.score for r in ql.with_scores(stats, model).collect()} == {want}
    assert ql.statistics(docs.limit(0)).count() == 0
    assert ql.keep_good(docs, ql.Model(0.2)).count() == 0 and ql.keep_good(docs, ql.Model(0.9)).columns == docs.columns


# --- Tool calls --------------------------------------------------------------------

def call(own, name, **arguments):
    return f"text <tool_call>{json.dumps({'id': own, 'name': name, 'arguments': arguments})}</tool_call> more"


def result(own, content):
    return json.dumps({"tool_call_id": own, "content": content})


SCHEMAS = {"f": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {
    "x": {"type": ["integer", "string"], "minimum": 0, "pattern": "^a?"}, "y": {"type": "array", "items": {"type": "number"}},
    "z": {"enum": [1, None]}, "s": {"type": "string", "maxLength": 2}}}}


def test_calls_are_linked_ordered_and_checked(spark):
    ref = lambda k: {"$ref": k}
    rows = [
        (1, 0, "assistant", call("a", "f", x=1.0, y=[1, 2.5]) + call("b", "f", x=ref("a"))), (1, 1, "tool", result("a", "r1")),
        (1, 2, "tool", result("a", "r2")), (1, 3, "assistant", call("c", "f", x=ref("b"), s="abc", q=1)), (1, 4, "tool", result("c", "ü\n")),
        (1, 5, "assistant", call("a", "f", x=2)), (1, 6, "tool", result("zz", "?")), (2, 0, "tool", result("a", "early")),
        (2, 1, "assistant", call("a", "g")), (2, 2, "assistant", call("p", "f", x=ref("q")) + call("q", "f", x=ref("p"))),
        (2, 3, "assistant", call("r", "f", x=ref("q"), z=2, y=["n"])), (2, 4, "assistant", call("m", "f", x=ref("nowhere"))),
        (3, 0, "assistant", "<tool_call>no json</tool_call>"), (3, 1, "user", None), (3, 2, None, ""), (None, 0, "assistant", call("a", "f", x=-1)),
        (4, 0, "assistant", call("d", "f", x="b")), (4, 0, "assistant", call("d", "f", x="b"))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, status string")
    got = tc.link_tool_calls(df, SCHEMAS).collect()
    by = {(r.conv_id, r.call_id, r.turn, r.place): r for r in got if r.status not in ("duplicate", "orphan", "malformed")}
    assert (by[1, "a", 0, 0].status, by[1, "a", 0, 0].result_turn, by[1, "b", 0, 1].status) == ("linked", 1, "unanswered")
    assert [by[k].level for k in ((1, "a", 0, 0), (1, "b", 0, 1), (1, "c", 3, 0))] == [0, 1, 2]
    assert by[1, "a", 0, 0].record == '{"arguments":{"x":1,"y":[1,2.5]},"id":"a","name":"f","result":"r1"}'
    assert by[1, "c", 3, 0].errors == "$.q: unknown; $.s: maxLength" and '"result":"ü\\n"' in by[1, "c", 3, 0].record
    assert by[2, "a", 1, 0].status == "early" and by[2, "a", 1, 0].errors == "$: no schema"
    assert by[2, "p", 2, 0].level is None and by[2, "q", 2, 1].level is None and by[2, "r", 3, 0].level is None
    assert by[2, "r", 3, 0].errors == "$.y[0]: type; $.z: enum"
    assert by[2, "m", 4, 0].missing_refs == "nowhere" and by[2, "m", 4, 0].level == 0
    assert by[None, "a", 0, 0].errors == "$.x: minimum"
    others = sorted((r.status, str(r.conv_id), r.turn, r.result_turn) for r in got if r.status in ("duplicate", "orphan", "malformed"))
    assert others == [("duplicate", "1", 5, None), ("duplicate", "4", 0, None), ("malformed", "3", 0, None), ("orphan", "1", None, 6)]
    assert tc.link_tool_calls(df.limit(0), SCHEMAS).count() == 0


def test_odd_calls_have_defined_results(spark):
    """Deep, lone surrogates, huge numbers, marks in strings, identifiers with quotes, arguments in strings, broken blocks."""
    def raw(own, body, name="g"):
        return f'<tool_call> {{"id": {json.dumps(own)}, "name": "{name}", "arguments": {body}}} </tool_call>'

    deep, bottomless = '{"a":' * 600 + "1" + "}" * 600, "[" * 500_000 + "]" * 500_000
    quoted = 'q"\\x'
    texts = [raw("deep", deep) + raw("after", json.dumps({"$ref": quoted})), raw("odd", '"\\ud800 x"'), raw("big", '{"x": 1e999}', "f"),
             raw("mark", json.dumps({"s": "a</tool_call>b <tool_call>"})), raw(quoted, "{}"), raw("text", json.dumps('{"x":1}'), "f"),
             raw("none", "null"), raw("endless", bottomless), raw("nan", "NaN"), "<tool_call>[1]</tool_call><tool_call>{}", raw(7, "1.0")]
    df = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)] + [(1, 20, "tool", result(quoted, "yes"))],
                               "conv_id long, turn long, role string, text string")
    rows = tc.link_tool_calls(df, SCHEMAS).collect()
    got = {r.call_id: r for r in rows if r.call_id is not None}
    assert sorted(r.turn for r in rows if r.status == "malformed") == [7, 8, 9]
    assert set(got) == {"deep", "after", "odd", "big", "mark", quoted, "text", "none", "7"}
    assert f'"arguments":{deep},' in got["deep"].record and got["deep"].errors == "$: no schema"
    assert got["after"].level == 1 and got["after"].missing_refs == "" and got[quoted].status == "linked"
    assert '"arguments":"\\ud800 x"' in got["odd"].record and got["odd"].errors == "$: no JSON"
    assert '{"x":1e999}' in got["big"].record and got["big"].errors == "$.x: type"
    assert '{"s":"a</tool_call>b <tool_call>"}' in got["mark"].record
    assert '"arguments":{"x":1},' in got["text"].record and got["text"].errors == ""
    assert '"arguments":null,' in got["none"].record and '"arguments":1,"id":"7"' in got["7"].record
    for r in rows:
        json.loads(r.record)


@pytest.mark.parametrize("turns", [512, 2])
def test_levels_across_blocks(spark, monkeypatch, turns):
    """Long chains, references ahead, several references and a circle, in one block and in many."""
    monkeypatch.setattr(tc, "TURNS", turns)
    refs = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(9)}
    refs |= {"d0": ["d5"], "d1": ["d0", "c8"], "d5": [], "e1": ["e7"], "e7": ["e1"], "e8": ["e7", "c1"]}
    rows = [(9, int(k[1:]), "assistant", call(k, "f", x=[{"$ref": r} for r in v])) for k, v in refs.items()]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.call_id: r.level for r in tc.link_tool_calls(df, SCHEMAS).collect()}
    assert got == {f"c{i}": i for i in range(9)} | {"d5": 0, "d0": 1, "d1": 9, "e1": None, "e7": None, "e8": None}


def test_long_chains_need_few_rounds(spark, monkeypatch):
    """A chain over 60 blocks, one of two references each over 60, and a circle with a chain behind it."""
    monkeypatch.setattr(tc, "TURNS", 1)
    monkeypatch.setattr(tc, "ROUNDS", 12, raising=False)
    rounds, staged = [], tc.stage_table
    monkeypatch.setattr(tc, "stage_table", lambda df, name="stage", **more: (rounds.append(name), staged(df, name, **more))[1])
    refs = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(60)}
    refs |= {f"d{i}": [f"d{k}" for k in (i - 1, i - 2) if k >= 0] for i in range(60)}
    refs |= {"e0": ["e1"], "e1": ["e0"], "e2": ["e1", "c59"]}
    rows = [(9, int(k[1:]), "assistant", call(k, "f", x=[{"$ref": r} for r in v])) for k, v in refs.items()]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.call_id: r.level for r in tc.link_tool_calls(df, SCHEMAS).collect()}
    assert got == {f"{k}{i}": i for k in "cd" for i in range(60)} | {"e0": None, "e1": None, "e2": None}
    assert rounds.count("calls-waiting") < 2 * 12


def test_canonical_json():
    value = json.loads('{"b": 1.0, "a": [true, null, 1e2, 0.5, "\\u00fc\\n\\"\\\\"], "\\ud83d\\ude00": 1, "\\ufb33": 2}')
    assert tc.canonical(value) == '{"a":[true,null,100,0.5,"ü\\n\\"\\\\"],"b":1,"\U0001f600":1,"\ufb33":2}'


# --- Pipeline ----------------------------------------------------------------------

def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = pq.read_table(f"{sf}/labels.parquet").to_pandas().set_index("doc_id")["quality"]
    counts, texts, names = [docs.count()], {}, [n for n, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stage_table(stage(spark, docs, sf), f"test-{name}")
        if name != "packing":
            assert docs.columns == before.columns
            texts[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
            counts.append(len(texts[name]))
    assert counts == sorted(counts, reverse=True) and names[-1] == "packing"
    kept = labels.index.isin(texts["quality"])
    assert (kept == (labels == 1)).mean() >= 0.97
    assert similar(texts["line_dedup"].values()) and not similar(texts["near_duplicates"].values())
    bench = pq.read_table(f"{sf}/benchmark.parquet")["text"].to_pylist()
    dirty = {k for k, t in texts["near_duplicates"].items() if hit_words(t, bench)}
    assert dirty and set(texts["decontamination"]) == set(texts["near_duplicates"]) - dirty
    packed = docs.toPandas()
    assert set(packed["doc_id"]) == set(texts["decontamination"])
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
