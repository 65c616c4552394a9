"""A model that raises on some sections loses those only."""

from tempolith.operators import extract, parse, sections


def load():
    def model(asks):
        if any("bad" in a for a in asks):
            raise RuntimeError("out of memory")
        return [f'[{{"SACT": "{a[2:-9]}", "relation": "BEGINS-ON", "time": "2024"}}]' for a in asks]

    return model


def test_failing_sections_stand_alone(spark):
    texts = [f"{'bad' if i in (3, 4, 17) else 'drug'} {i}" for i in range(30)]
    notes = spark.createDataFrame([("p", f"d{i:02d}", t) for i, t in enumerate(texts)], "patient_id string, doc_id string, text string").coalesce(2)
    raw = extract.by_model(sections.whole_sections(notes), "P:", load, size=8)
    tlinks, errors = parse.parse_outputs(raw)
    assert sorted(r.sact for r in tlinks.collect()) == sorted(t for t in texts if "bad" not in t)
    assert {(r.doc_id, r.llm_out, r.error) for r in errors.collect()} == {(f"d{i:02d}", None, "RuntimeError: out of memory") for i in (3, 4, 17)}


def test_a_wrong_number_of_outputs_is_an_error():
    found = extract._asked(lambda asks: asks[:-1] if len(asks) > 1 else asks, ["a", "b", "c"], {})
    assert found == [("a", None), ("b", None), ("c", None)]
    assert extract._asked(lambda asks: [], ["a"], {}) == [(None, "ValueError: 0 outputs of 1 instructions")]
