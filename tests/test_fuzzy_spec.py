import random

from voltfleet.operators import joins


def test_specs_are_found_without_meeting_all_models(spark, capsys):
    draw = random.Random(3)
    text = lambda: draw.choice([None, "", *[" ".join(draw.choice(["Abc", "bc", "abcd", "x", "İx"]) for _ in range(draw.randint(1, 3))) for _ in range(12)]])
    source = lambda: draw.choice(["a", "b", "c", None])
    rows = [(k, source(), text()) for k in range(300)]
    specs = [(s, text(), k) for k in range(40) if (s := source()) != "c"]
    got = joins.fuzzy_spec(spark.createDataFrame(rows, "id int, source string, name string"), "name", spark.createDataFrame(specs, "source string, model string, spec_id int"))

    def rank(name, model):
        if name is None or model is None:
            return 2
        name, model = name.lower(), model.lower()
        return 0 if model in name else 1 if name.split(" ")[0] == model.split(" ")[0] else 2

    for r in got.collect():
        found = [(rank(r["name"], m), k) for s, m, k in specs if s is not None and s == r["source"]]
        assert r["spec_id"] == (min(found)[1] if found else None)
    assert got.count() == len(rows)
    got.explain()
    assert "Contains" not in capsys.readouterr().out
