"""Notes to tables and timelines, end to end, on notes of our own."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tempolith.operators import align, extract, header, parse, sections, tables, timeline
from tempolith.__main__ import main
from tempolith.functions.literals import read_literal
from tempolith.plans import script
from tempolith.plans.catalogue import QUERIES
from tempolith.plans.notes_to_timeline import Config, counters, plan
from tempolith.schemas import RECORDED, SPAN_HEADER
from tempolith.sinks import files, render
from tempolith.sources import notes as sources
from tempolith.streaming import notes as stream_notes
from tempolith.streaming import timelines

NOTE = """Report ID.....n1
Principal Date................20240110 0930
Record Type...................CLINIC NOTE

HISTORY::
She started cisplatin on January 2, 2024. Cisplatin was given yesterday, after 6 months of tamoxifen.
PLAN::
Last dose of Cisplatin on January 9, 2024.
"""
LATER = "Principal Date....20240301\nRecord Type....PHONE CALL\ncisplatin ended on January 2, 2024.\n"
LINKS = [
    ("cisplatin", "BEGINS-ON", "January 2, 2024"),
    ("Cisplatin", "CONTAINS-1", "yesterday"),
    ("Cisplatin", "ENDS-ON", "January 9, 2024"),
    ("tamoxifen", "CONTAINS-1", "6 months"),
    ("aspirin", "CONTAINS-1", "nowhere"),
]


def output(links):
    return "<think>\n</think>\n" + json.dumps([dict(zip(("SACT", "relation", "time"), x, strict=True)) for x in links])


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("notes") / "corpus"
    for patient, doc, text in (("p 1", "n1", NOTE), ("p 1", "n2", LATER), ("p2", "n1", "No header, no drug."), ("p3", "n1", "\n")):
        (root / patient).mkdir(parents=True, exist_ok=True)
        (root / patient / f"{doc}.txt").write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def run(spark, corpus):
    notes = sources.read_notes(spark, corpus)
    rows = [("p 1", "n1", 0, output(LINKS)), ("p 1", "n2", 0, output([("cisplatin", "ENDS-ON", "January 2, 2024")])), ("p2", "n1", 0, "sorry"), ("p3", "n1", 0, "[]")]
    recorded = spark.createDataFrame(rows, RECORDED)
    return plan(notes, lambda s: extract.recorded(s, recorded), Config())


def test_source(spark, corpus):
    rows = {(r.patient_id, r.doc_id): r for r in sources.read_notes(spark, corpus).collect()}
    assert set(rows) == {("p 1", "n1"), ("p 1", "n2"), ("p2", "n1"), ("p3", "n1")}
    assert rows["p 1", "n1"].text == NOTE and rows["p 1", "n1"].corpus == "corpus" and rows["p3", "n1"].text == "\n"


def test_small_notes_are_read_by_few_tasks(spark, tmp_path):
    """Six hundred notes make as many tasks as there are cores, and the session's own settings stay."""
    for i in range(600):
        (tmp_path / f"p{i % 7}").mkdir(exist_ok=True)
        (tmp_path / f"p{i % 7}" / f"n{i}.txt").write_text(f"note {i}")
    before = spark.conf.getAll
    notes = sources.read_notes(spark, str(tmp_path))
    assert notes.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
    assert notes.sparkSession is spark and spark.conf.getAll == before
    notes.createOrReplaceTempView("small_notes")  # a name of the caller's session
    rows = spark.sql("select patient_id, doc_id, text from small_notes").collect()
    assert {tuple(r) for r in rows} == {(f"p{i % 7}", f"n{i}", f"note {i}") for i in range(600)} and len(rows) == 600


def test_scanned_notes_lie_in_folders_that_tasks_list(spark, sf_dir):
    """More than 32 folders side by side: the executors list them, not the driver alone."""
    paths = QUERIES["scan_notes"](spark, sf_dir).inputFiles()
    assert len({p.split("/")[-3] for p in paths}) > 32


def test_prompt_and_corpus_name(spark, tmp_path):
    (tmp_path / "prompt.txt").write_text("Say é.\n", encoding="utf-8")
    assert sources.read_prompt(str(tmp_path / "prompt.txt")) == "Say é.\n"
    assert sources.corpus_name("/a/b/") == "b" and sources.corpus_name("") == "Corpus not set"


def test_meta(run):
    meta = {(r.patient_id, r.doc_id): r for r in run.meta.collect()}
    assert str(meta["p 1", "n1"].doc_ts) == "2024-01-10 09:30:00" and meta["p 1", "n1"].doc_type == "CLINIC NOTE"
    assert str(meta["p 1", "n2"].doc_ts) == "2024-03-01 12:00:00"
    assert meta["p2", "n1"].doc_ts is not None and meta["p2", "n1"].doc_type == ""  # the file's own time


def test_timeline(run):
    got = {tuple(r) for r in run.timeline.collect()}
    # begin and end on one day become one containment, with the first spelling
    assert got == {("p 1", "cisplatin", "contains-1", "2024-01-02"), ("p 1", "Cisplatin", "ENDS-ON", "2024-01-09")}


def test_errors_are_quarantined(run):
    assert [(r.patient_id, r.llm_out) for r in run.errors.collect()] == [("p2", "sorry")]


def test_spans(run):
    rows = run.span_rows.where("patient_id = 'p 1' and doc_id = 'n1'").orderBy("sort_key").collect()
    assert all(NOTE[slice(*map(int, r.med_span.split(",")))] == r.med_text for r in rows)
    assert all(NOTE[slice(*map(int, r.timex_span.split(",")))] == r.timex for r in rows)
    assert ("tamoxifen", "6 Month", "DURATION", "P6M") in {(r.med_text, r.time_normal, r.time_type, r.iso) for r in rows}
    assert not any(r.med_text == "aspirin" for r in rows)


def test_exact_alignment_equals_fuzzy_where_all_is_exact(spark, corpus, run):
    exact = align.mentions(run.tlinks, run.sections, None)
    pick = ["patient_id", "doc_id", "kind", "concept_text", "begin", "end", "covered_text"]
    assert set(map(tuple, exact.select(pick).collect())) == set(map(tuple, run.mentions.select(pick).collect()))


def test_corpus_json(run, tmp_path):
    path = str(tmp_path / "out.json")
    files.write_corpus_json(timeline.patient_entries(run.timeline, run.patients), path)
    with open(path) as f:
        got = json.load(f)
    assert got == {"p 1": [["Cisplatin", "ENDS-ON", "2024-01-09"], ["cisplatin", "contains-1", "2024-01-02"]], "p2": [], "p3": []}


@pytest.mark.parametrize("form", render.FORMATS)
def test_document_files(run, tmp_path, form):
    content = render.document_tables(run.span_rows, form, SPAN_HEADER, list(tables.ROW9), ["patient_id", "doc_id"])
    paths = [r.path for r in files.write_documents(content, str(tmp_path), "spans", form).collect()]
    assert os.path.join(str(tmp_path), "p 1", f"n1_spans.{form}") in paths
    with open(os.path.join(str(tmp_path), "p 1", f"n1_spans.{form}")) as f:
        assert "2024-01-09 00:00" in f.read()


def test_stream_equals_batch(spark, run, tmp_path):
    links = timeline.instants(run.normals)
    want = {tuple(r) for r in timeline.resolve(links).collect()}
    rows = [r.asDict() for r in links.collect()]
    for doc in ("n1", "n2"):  # one patient in two micro-batches, the later note first
        part = spark.createDataFrame([tuple(r[c] for c in ("patient_id", "doc_id", "tlink_id", "med_text", "relation", "time_normal")) for r in rows if r["doc_id"] != doc], timelines.LINKS)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(timelines.LINKS).parquet(str(tmp_path / "in"))
        timelines.start(stream, str(tmp_path / "store"), str(tmp_path / "state")).awaitTermination()
    assert {tuple(r) for r in timelines.timelines(spark, str(tmp_path / "store")).collect()} == want


def test_lexicon_and_model(spark, corpus):
    parts = sections.titled_sections(sources.read_notes(spark, corpus))
    rows = extract.lexicon(parts, ["cisplatin", "tamoxifen"]).collect()
    got = {(r.sact, r.relation, r.time) for r in rows}
    assert ("cisplatin", "BEGINS-ON", "January 2, 2024") in got and ("Cisplatin", "ENDS-ON", "January 9, 2024") in got
    again, errors = parse.parse_outputs(extract.as_outputs(extract.lexicon(parts, ["cisplatin", "tamoxifen"]), parts))
    assert {(r.sact, r.relation, r.time) for r in again.collect()} == got and errors.isEmpty()
    out = extract.by_model(parts, "P:", lambda: lambda asks: [f"[{len(a)}]" for a in asks], 2)
    lengths = {(r.doc_id, r.section_id): len(r.text) for r in parts.where("patient_id = 'p 1'").collect()}
    assert {(r.doc_id, r.section_id): r.llm_out for r in out.where("patient_id = 'p 1'").collect()} == {k: f"[{n + 2 + len('/no_think')}]" for k, n in lengths.items()}


def test_titled_sections_cover_the_text(spark, corpus):
    parts = sections.titled_sections(sources.read_notes(spark, corpus)).where("patient_id = 'p 1' and doc_id = 'n1'").orderBy("section_id").collect()
    assert "".join(p.text for p in parts) == NOTE and all(NOTE[p.begin : p.end] == p.text for p in parts) and len(parts) == 3


def test_header_hours(spark):
    rows = spark.createDataFrame([("202401012400",), ("202401010030",), ("2024010",), ("202413010000",)], "d string")
    got = [None if r[0] is None else str(r[0]) for r in rows.select(header.parse_doc_time(rows.d)).collect()]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 00:30:00", None, None]


def test_malformed_outputs(spark):
    outs = ["no brackets", "[", "null", "[{'SACT': 'a', 'relation': 'b', 'time': 'c'}]", '[{"SACT": "a", "time": "c",},]', "[]", '[{"SACT": "a", "relation": "b", "time": 3}]', 'pre [{"SACT": "a"}] post', None]
    raw = spark.createDataFrame(list(enumerate(outs)), "section_id int, llm_out string")
    links, errors = parse.parse_outputs(raw)
    assert {(r.section_id, r.sact, r.relation, r.time) for r in links.collect()} == {(3, "a", "b", "c"), (4, "a", "Unknown_relation", "c"), (6, "a", "b", "3"), (7, "a", "Unknown_relation", "Unknown_time")}
    assert {r.section_id for r in errors.collect()} == {0, 1, 2, 8}


CONFLICTS = [
    (["BEGINS-ON", "CONTAINS-1"], {"BEGINS-ON"}),
    (["ENDS-ON", "CONTAINS-1"], {"ENDS-ON"}),
    (["BEGINS-ON", "ENDS-ON"], {"contains-1"}),
    (["BEGINS-ON", "ENDS-ON", "CONTAINS-1"], {"contains-1"}),
    (["BEGINS-ON"], {"BEGINS-ON"}),
    (["CONTAINS-1"], {"CONTAINS-1"}),
    (["Unknown_relation", "BEGINS-ON", "ENDS-ON"], {"Unknown_relation", "contains-1"}),
    (["begins-on", "BEGINS-ON"], {"begins-on"}),
]


def test_conflicts(spark):
    rows = [(str(i), "d", n, "Med" if n % 2 else "med", r, "2024") for i, (given, _) in enumerate(CONFLICTS) for n, r in enumerate(given)]
    got = timeline.resolve(spark.createDataFrame(rows, timelines.LINKS)).collect()
    for i, (_, want) in enumerate(CONFLICTS):
        assert {r.relation for r in got if r.patient_id == str(i)} == want, i


def test_fuzzy_alignment():
    quote = "the quick brown fox jumps over the lazy dog " * 5
    near = quote.replace("lazy", "hazy", 1)
    found = align.spans("x" * 300 + near + "y" * 300, quote)
    assert len(found) == 1 and found[0][3] == "match_fuzzy" and found[0][0] == 300
    assert align.spans("x" * 200 + "short quote here" + "y" * 200, "short quota here") == []
    assert align.spans("abab ab", "ab") == [(0, 2, 1.0, "match_exact"), (2, 4, 1.0, "match_exact"), (5, 7, 1.0, "match_exact")]
    assert align.spans("", "a") == align.spans("a", "") == align.spans(None, "a") == []


def test_quotes_are_literal(spark):
    pairs = spark.createDataFrame([(1, "a.b a+b\\E a.b", "a.b"), (2, "x\\Ey", "\\E"), (3, "abc", ""), (4, None, "a")], "id int, text string, quote string")
    got = [tuple(r) for r in align.exact_spans(pairs, ["id"]).orderBy("id", "n").collect()]
    assert got == [(1, 0, 0, 3), (1, 1, 10, 13), (2, 0, 1, 3)]


def common_blocks(a, b):
    """Matching blocks by their definition: the longest common stretch, the earliest of such, then what is left and right of it."""
    best = (0, 0, 0)
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            if k > best[2]:
                best = (i, j, k)
    i, j, k = best
    if not k:
        return []
    return [*common_blocks(a[:i], b[:j]), best, *((x + i + k, y + j + k, z) for x, y, z in common_blocks(a[i + k :], b[j + k :]))]


def brute_nearest(text, quote, how):
    rows = []
    for i in range(0, max(1, len(text) - len(quote) + 1), max(how.min_step, len(quote) // how.step_fraction)):
        window = text[i : i + len(quote) + how.padding]
        blocks = common_blocks(quote, window)
        score = 2 * sum(z for *_, z in blocks) / (len(quote) + len(window))
        if score >= how.threshold:
            a, b, _ = max(blocks, key=lambda x: x[2])
            rows.append((-score, i, max(0, i + b - a)))
    return (min(rows)[2], -min(rows)[0]) if rows else None


def test_nearest_window_equals_brute_force():
    rng, found = random.Random(1), 0
    for _ in range(800):
        letters = rng.choice(["ab ", "abcdefgh ", "abé𝄞 "])
        how = align.Matching(threshold=rng.choice([0.85, 0.6, 0.5, 0.75]), min_step=rng.choice([1, 2, 8]), padding=rng.choice([0, 4, 10]))
        quote = "".join(rng.choice(letters) for _ in range(rng.randint(1, 22)))
        near = list(quote)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(len(near))] = rng.choice(letters + "x")
        around = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))  # noqa: E731, B023
        text = around() + "".join(near) + around()
        want = brute_nearest(text, quote, how)
        assert align.nearest(text, quote, how) == want, (text, quote, how)
        found += want is not None
    assert found > 300


def test_python_lists_are_read_as_python_reads_them(spark):
    """Lists that the JVM repairs and lists that go to Python give what a literal gives."""
    rng = random.Random(2)
    value = lambda: rng.choice(["'a'", '"b, ]"', "'it, }'", "None", "'None'", '"x None, ]"', "7", "1.5", "''", "'q\\'s'", '"\\u00b0"', "'\\x41'", "True", "(1, 2)", "'say \"hi\"'", "'a' 'b'"])
    bodies = []
    for _ in range(300):
        items = ["{" + ", ".join(f"{rng.choice(chr(39) + chr(34))}{k}" + rng.choice("'\"") + f": {value()}" for k in rng.sample(["SACT", "relation", "time", "other"], rng.randint(0, 4))) + rng.choice(["", "", ","]) + "}" for _ in range(rng.randint(0, 3))]
        bodies.append("[" + ", ".join(items) + rng.choice(["", ",", " , "]) + "]")
    raw = spark.createDataFrame(list(enumerate(bodies)), "section_id int, llm_out string")
    links, errors = parse.parse_outputs(raw)
    got = {}
    for r in links.orderBy("section_id", "pos").collect():
        got.setdefault(r.section_id, []).append((r.sact, r.relation, r.time))
    bad = {r.section_id for r in errors.collect()}
    unknown = {"SACT": "Unknown_SACT", "relation": "Unknown_relation", "time": "Unknown_time"}
    for i, body in enumerate(bodies):
        want = read_literal(body)
        if want is not None:
            assert i not in bad and got.get(i, []) == [tuple(x[k] if x[k] is not None else u for k, u in unknown.items()) for x in want], body
    assert sum(read_literal(b) is not None for b in bodies) > 60


def test_long_outputs_are_repaired(spark):
    body = "[" + ", ".join("{'SACT': 'drug %d', 'relation': None, 'time': '%s',}" % (i, "x" * 500) for i in range(3000)) + ",]"
    links, errors = parse.parse_outputs(spark.createDataFrame([(0, body)], "section_id int, llm_out string"))
    assert links.count() == 3000 and errors.isEmpty()


def test_sentences_and_tokens_cover_the_text(spark):
    texts = ["One. Two!  Three?", " lead. trail ", "", "no end", "...", "Dr. é𝄞 x\n\ny?z", "  "]
    docs = spark.createDataFrame([("p", str(i), t) for i, t in enumerate(texts)], "patient_id string, doc_id string, text string")
    for parts in (sections.sentences(docs), sections.tokens(docs)):
        rows = parts.collect()
        assert all(texts[int(r.doc_id)][r.begin : r.end] == r.text and r.text == r.text.strip() for r in rows)
        for i, t in enumerate(texts):
            assert "".join("".join(r.text.split()) for r in sorted((r for r in rows if r.doc_id == str(i)), key=lambda r: r.begin)) == "".join(t.split())


def test_counters(run):
    got = dict(map(tuple, counters(run).collect()))
    assert got["documents"] == 4 and got["sections"] == 4 and got["triplets"] == 6 and got["outputs in quarantine"] == 1
    assert got["texts without mention"] == 2 and got["timeline rows"] == 2  # aspirin, nowhere


def test_models_and_their_limits(spark, corpus):
    parts = sections.whole_sections(sources.read_notes(spark, corpus))
    out = extract.by_model(parts, "P:", lambda: lambda asks, max_new_tokens: [a[:max_new_tokens] for a in asks], 2, max_new_tokens=4, limited=True)
    assert {r.llm_out[:2] for r in out.collect()} == {"P:"} and all(len(r.llm_out) == 4 for r in out.collect())


GOLDEN = """Report ID.....g1
Principal Date................20240115 0930
Record Type...................CLINIC NOTE

HISTORY::
Taxol was begun on January 2, 2024. taxol and Taxol again on January 2, 2024.
Completed radiation yesterday; took aspirin for 6 months, or so.
"""
GOLDEN_LINKS = [("Taxol", "BEGINS-ON", "January 2, 2024"), ("radiation", "ENDS-ON", "yesterday"), ("aspirin", "CONTAINS-1", "6 months"), ("aspirin", "CONTAINS-1", "or so"), ("Taxol", "CONTAINS-1", "January 2, 2024")]
#: rows and their order by hand, places by search in the note
GOLDEN_SPANS = """ Medication Normal | Medication Text | Medication Span | Temporal Relation | Normalized Time | Time Text | Time Span | Time Type | TimeNorm ISO 
Taxol|Taxol|{t1}|BEGINS-ON|2024-01-02 00:00|January 2, 2024|{d1}|INSTANT|2024-01-02
Taxol|Taxol|{t1}|BEGINS-ON|2024-01-02 00:00|January 2, 2024|{d2}|INSTANT|2024-01-02
Taxol|Taxol|{t2}|BEGINS-ON|2024-01-02 00:00|January 2, 2024|{d1}|INSTANT|2024-01-02
Taxol|Taxol|{t2}|BEGINS-ON|2024-01-02 00:00|January 2, 2024|{d2}|INSTANT|2024-01-02
Taxol|Taxol|{t1}|CONTAINS-1|2024-01-02 00:00|January 2, 2024|{d1}|INSTANT|2024-01-02
Taxol|Taxol|{t1}|CONTAINS-1|2024-01-02 00:00|January 2, 2024|{d2}|INSTANT|2024-01-02
Taxol|Taxol|{t2}|CONTAINS-1|2024-01-02 00:00|January 2, 2024|{d1}|INSTANT|2024-01-02
Taxol|Taxol|{t2}|CONTAINS-1|2024-01-02 00:00|January 2, 2024|{d2}|INSTANT|2024-01-02
aspirin|aspirin|{a}|CONTAINS-1|6 Month|6 months|{m}|DURATION|P6M
aspirin|aspirin|{a}|CONTAINS-1||or so|{o}|FAILED_NORMALIZATION|
radiation|radiation|{r}|ENDS-ON|2024-01-14 00:00|yesterday|{y}|INSTANT|2024-01-14

"""


def test_command_line_writes_whole_files(spark, tmp_path):
    """Notes and recorded outputs to files, byte by byte, the run told by a file that loads another one."""
    notes = tmp_path / "corpus"
    (notes / "p1").mkdir(parents=True)
    (notes / "p1" / "g1.txt").write_text(GOLDEN)
    (tmp_path / "recorded.jsonl").write_text(json.dumps({"patient_id": "p1", "doc_id": "g1", "section_id": 0, "llm_out": output(GOLDEN_LINKS)}) + "\n")
    (tmp_path / "base.json").write_text(json.dumps({"set": {"root": "nowhere"}, "notes": "${root}/corpus", "tables": "html"}))
    (tmp_path / "run.json").write_text(json.dumps({"load": ["base.json"], "notes": "${root}/corpus", "recorded": "${root}/recorded.jsonl", "out": "${root}/out", "tables": "bsv,csv"}))
    assert script.read(str(tmp_path / "base.json"))["notes"] == "nowhere/corpus"
    main(["--script", str(tmp_path / "run.json"), "--set", f"root={tmp_path}"], spark)
    at = lambda text, nth=1: f"{(b := [i for i in range(len(GOLDEN)) if GOLDEN.startswith(text, i)][nth - 1])},{b + len(text)}"
    want = GOLDEN_SPANS.format(t1=at("Taxol"), t2=at("Taxol", 2), d1=at("January 2, 2024"), d2=at("January 2, 2024", 2), a=at("aspirin"), m=at("6 months"), o=at("or so"), r=at("radiation"), y=at("yesterday"))
    assert (tmp_path / "out" / "p1" / "g1_medTimeSpans.bsv").read_text() == want
    assert (tmp_path / "out" / "corpus_medTlinks.json").read_text() == '{\n  "p1": [\n    ["Taxol", "BEGINS-ON", "2024-01-02"],\n    ["radiation", "ENDS-ON", "2024-01-14"]\n  ]\n}\n'
    assert sorted(os.listdir(tmp_path / "out")) == ["corpus_medTlinks.json", "p1"]
    assert sorted(os.listdir(tmp_path / "out" / "p1")) == sorted(f"g1_{k}.{f}" for k in ("medTimes", "medTimeSpans", "medTimeMentions") for f in ("bsv", "csv"))


@pytest.mark.skipif("TEMPOLITH_SAMPLES" not in os.environ, reason="needs a folder of notes, recorded.jsonl and expected files")
def test_sample_corpus(spark, tmp_path):
    """Samples from elsewhere: ``notes``, ``recorded.jsonl`` and ``expected``, whose files must come out byte by byte."""
    root = os.environ["TEMPOLITH_SAMPLES"]
    main(["--notes", f"{root}/notes", "--recorded", f"{root}/recorded.jsonl", "--out", str(tmp_path), "--tables", "bsv,html"], spark)
    seen = 0
    for folder, _, names in os.walk(f"{root}/expected"):
        for name in names:
            path = os.path.relpath(os.path.join(folder, name), f"{root}/expected")
            with open(os.path.join(folder, name), encoding="utf-8") as want, open(os.path.join(tmp_path, path), encoding="utf-8") as got:
                assert got.read() == want.read(), path
            seen += 1
    assert seen


def test_stream_of_notes_equals_batch(spark, corpus, run, tmp_path):
    """Files of notes in small batches; a batch that is repeated leaves everything as it was."""
    rows = run.sections.select("patient_id", "doc_id").join(spark.createDataFrame([("p 1", "n1", output(LINKS)), ("p 1", "n2", output([("cisplatin", "ENDS-ON", "January 2, 2024")])), ("p2", "n1", "sorry"), ("p3", "n1", "[]")], "patient_id string, doc_id string, llm_out string"), ["patient_id", "doc_id"])
    recorded = rows.withColumn("section_id", F.lit(0))
    take = lambda s: extract.recorded(s, recorded)
    store, state = str(tmp_path / "store"), str(tmp_path / "state")
    stream = lambda: sources.stream_notes(spark, corpus, files_per_batch=1)
    stream_notes.start(stream(), take, store, state).awaitTermination()
    want = {tuple(r) for r in run.timeline.collect()}
    assert {tuple(r) for r in timelines.current(spark, store).collect()} == want == {tuple(r) for r in timelines.timelines(spark, store).collect()}
    batches = sorted(int(x) for x in os.listdir(os.path.join(state, "commits")) if x.isdigit())
    assert len(batches) == 4
    # the last batch was written, but not yet marked as done: it is run again
    os.remove(os.path.join(state, "commits", str(batches[-1])))
    os.remove(os.path.join(state, "commits", f".{batches[-1]}.crc"))
    stream_notes.start(stream(), take, store, state).awaitTermination()
    assert {tuple(r) for r in timelines.current(spark, store).collect()} == want
    assert timelines.stored(spark, store).count() == timeline.instants(run.normals).count()
    assert [tuple(r) for r in spark.read.parquet(f"{store}/errors").select("patient_id", "llm_out").collect()] == [("p2", "sorry")]
    counted = spark.read.parquet(f"{store}/counters").groupBy("name").sum("n").collect()
    assert dict(map(tuple, counted))["documents"] == 4


def test_plug_ins(spark, corpus, tmp_path, monkeypatch):
    """Steps before the plan, tables derived from it, a form of one's own for files."""
    monkeypatch.setitem(render.FORMS, "list", render.Form(lambda columns: F.concat_ws(";", *columns), lambda names: f"{len(names)} columns\n", foot="\nend\n"))
    config = Config(
        prepare=(lambda notes: notes.where("patient_id = 'p 1' and doc_id = 'n1'"), lambda notes: notes.withColumn("text", F.upper("text"))),
        derive={"drugs": lambda run: run.normals.groupBy("med_text").count()},
        meta=lambda parts: header.doc_meta(parts, "Clinic"),
        matching=None,
    )
    recorded = spark.createDataFrame([("p 1", "n1", 0, output([("CISPLATIN", "BEGINS-ON", "JANUARY 2, 2024")]))], RECORDED)
    made = plan(sources.read_notes(spark, corpus), lambda s: extract.recorded(s, recorded), config)
    assert [tuple(r) for r in made.derived["drugs"].collect()] == [("CISPLATIN", 1)]
    assert {r.institution for r in made.meta.collect()} == {"Clinic"}
    content = render.document_tables(made.table_rows, "list", ("a", "b"), ["med", "relation"], ["patient_id", "doc_id"]).first().content
    assert content == "2 columns\nCISPLATIN;BEGINS-ON\nend\n"


def test_a_model_is_asked_once(spark, corpus, tmp_path):
    """With tables kept, results that share a model's outputs don't ask it again."""
    asked = str(tmp_path / "asked")

    def load_model():
        def model(asks):
            with open(asked, "a") as f:
                f.write("x" * len(asks))
            return ["[]" for _ in asks]

        return model

    take = lambda parts: extract.by_model(parts, "P:", load_model)
    made = plan(sources.read_notes(spark, corpus), take, Config(matching=None, keep=files.keeper(str(tmp_path / "work"))))
    assert made.timeline.isEmpty() and made.errors.isEmpty() and counters(made).count() == 7
    with open(asked) as f:
        assert len(f.read()) == 4


def test_messages(spark):
    rows = [("note", "p", "d", "text", None, "l1"), ("STOP", None, None, None, None, "l2"), (None, None, None, None, "{x", "l3"), ("note", "p", None, "text", None, "l4")]
    messages = spark.createDataFrame(rows, "kind string, patient_id string, doc_id string, text string, malformed string, line string").selectExpr("*", "'c' as corpus", "cast(null as timestamp) as mtime")
    notes, malformed = stream_notes.route(messages)
    assert [r.text for r in notes.collect()] == ["text"] and {r.line for r in malformed.collect()} == {"l3", "l4"}


def test_timelines_of_changed_patients_only(spark, tmp_path):
    store = str(tmp_path)
    row = lambda p, n, r, t="2024": (p, "d", n, "med", r, t)
    for batch, rows in enumerate([[row("a", 0, "BEGINS-ON"), row("b", 0, "CONTAINS-1")], [row("a", 1, "ENDS-ON"), row("c", 0, "BEGINS-ON")], [row("b", 1, "BEGINS-ON")]]):
        links = spark.createDataFrame(rows, timelines.LINKS)
        timelines.add(links, store, batch)
        timelines.refresh(links, store, batch)
    want = {("a", "med", "contains-1", "2024"), ("b", "med", "BEGINS-ON", "2024"), ("c", "med", "BEGINS-ON", "2024")}
    assert {tuple(r) for r in timelines.current(spark, store).collect()} == want == {tuple(r) for r in timelines.timelines(spark, store).collect()}
    written = spark.read.parquet(f"{store}/timelines").groupBy("batch").agg(F.collect_set("patient_id").alias("p")).collect()
    assert {r.batch: set(r.p) for r in written} == {0: {"a", "b"}, 1: {"a", "c"}, 2: {"b"}}


def test_header_choices(spark):
    """Strict dates: what is no date gives none, and the file's time or the given day takes its place."""
    notes = spark.createDataFrame([("p", "d1", "Principal Date....20241301"), ("p", "d2", "Principal Date....202401021"), ("p", "d3", "Principal Date....20240102 2460")], "patient_id string, doc_id string, text string").withColumn("mtime", F.lit(None).cast("timestamp"))
    meta = header.doc_meta(sections.whole_sections(notes), "Clinic")
    assert all(r.doc_ts is None and r.institution == "Clinic" for r in meta.collect())
    anchored = header.anchor(meta, notes, F.lit("2024-05-06").cast("date"))
    assert {str(r.doc_date) for r in anchored.collect()} == {"2024-05-06"}


def test_span_rows_are_distinct_before_the_join(spark):
    """Each row once with its least sort key, nulls first; nothing is gathered or shuffled behind the join."""
    normals = [("p", "d", n, "med", "r", "on", "INSTANT", "t", "i", "x", "1,2") for n in (7, None, 3)] + [("p", "d", 1, "med", "r2", "on", "INSTANT", "t", "i", "x", "1,2")]
    normals = spark.createDataFrame(normals, "patient_id string, doc_id string, tlink_id long, med_text string, category string, time_text string, time_type string, time_normal string, iso string, timex string, timex_span string")
    found = spark.createDataFrame([("p", "d", "MED", "med", b, e, "Med") for b, e in ((4, 9), (4, 9), (9, None), (None, 9))], "patient_id string, doc_id string, kind string, concept_text string, begin int, end int, covered_text string")
    rows = tables.span_rows(normals, found)
    got = sorted((r.relation, r.med_span, r.sort_key.tlink_id, r.sort_key.b, r.sort_key.e) for r in rows.collect())
    assert got == [("r", "4,9", None, 4, 9), ("r", "9", None, None, 9), ("r2", "4,9", 1, 4, 9), ("r2", "9", 1, None, 9)]
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    above = plan[: plan.index("Join")]
    assert "Aggregate" not in above and "Exchange" not in above


def test_many_notes_are_listed_and_read_by_tasks(spark, tmp_path):
    """The same rows as Spark's own reader gives, without a list of files in the driver's plan."""
    names = ["a/n1.txt", "a/b c/n+2.txt", "a/deep/er/and/é%20%.txt", "top.txt", "_hidden.txt", ".dot/n.txt", "_tmp/n.txt", "_k=v/n.txt", "a/none.txt", "a/n.text", "_metadata.txt", "a/n._COPYING_"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "none" in name else f"note é {name}".encode() + b"\xff\r\n")
    (tmp_path / "linked").symlink_to(tmp_path / "a" / "deep")
    own = sources.read_notes(spark, f"file:{tmp_path}", most_listed=0)
    assert own.inputFiles() == [] and own.sparkSession is spark
    usual = sources.read_notes(spark, str(tmp_path))
    assert usual.inputFiles() and own.schema == usual.schema
    rows = sorted(map(tuple, own.collect()))
    assert rows == sorted(map(tuple, usual.collect())) and len(rows) == 6


def test_notes_are_handed_over_in_batches(spark, tmp_path, monkeypatch):
    for i in range(50):
        (tmp_path / f"n{i}.txt").write_text("x" * (i + 1))
    monkeypatch.setattr(sources, "_BATCH", 20)
    assert {(r.doc_id, r.text) for r in sources.read_notes(spark, str(tmp_path), most_listed=49).collect()} == {(f"n{i}", "x" * (i + 1)) for i in range(50)}
