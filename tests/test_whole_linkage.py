"""The registered training query uses the operator's own settings."""


def test_predict_links_trains_as_the_operator_does(monkeypatch):
    from types import SimpleNamespace

    from kinweave.plans import queries

    seen = []
    monkeypatch.setattr(queries, "Data", lambda spark, d: SimpleNamespace(ents=None, pairs=None, gt=None))
    monkeypatch.setattr(queries.flow, "all_features", lambda *a: "all")
    monkeypatch.setattr(queries.flow, "held", lambda df: df)
    monkeypatch.setattr(queries.flow, "sampled_features", lambda *a: "rows")
    monkeypatch.setattr(queries.model, "train", lambda *a, **k: seen.append((a, k)))
    monkeypatch.setattr(queries.model, "predict", lambda *a: None)
    queries.Q["predict_links"](None, None)
    assert seen == [(("rows",), {})]
