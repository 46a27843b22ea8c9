"""Terms that give an entity away are marked wherever they stand."""

from layerwright.llm import pii


def _docs(spark):
    near = "the parcel for Quimby went to q.uimby@mail.example yesterday morning"
    rows = [*[(i, f"{near} {i}") for i in range(4)], *[(100 + i, "yesterday morning the parcel went for nobody") for i in range(1000)],
            (50, "Quimby alone"), (51, near + " one" * 300 + " Quimby."), (52, "ask Quimbys or quimby"), (53, "Quimby Quimby 77"),
            (54, "Quimby@mail.example"), (60, None), (61, ""), (50, "Quimby alone"), (None, "Quimby alone")]
    return spark.createDataFrame(rows, "k long, text string")


def test_terms_far_from_the_entity_are_spans(spark):
    docs = _docs(spark)
    found = pii.find(docs, "k", "text", everywhere=True).collect()
    assert len(found) == docs.count()
    texts = {r.k: r.text or "" for r in docs.collect()}
    marked = sorted((str(r.k), [texts[r.k][t.start:t.end] for t in r.terms]) for r in found if r.terms)
    assert marked == sorted([*[(str(i), ["Quimby"]) for i in range(4)], ("50", ["Quimby"]), ("50", ["Quimby"]), ("51", ["Quimby"] * 2),
                             ("53", ["Quimby"] * 2), ("None", ["Quimby"])])
    assert len({t.disclosure for r in found for t in r.terms}) == 1


def test_terms_far_from_the_entity_are_sanitised(spark):
    docs = _docs(spark)
    out = pii.sanitise(docs, "k", "text", remove=2.0, everywhere=True)
    assert out.schema == docs.schema
    got = sorted((str(r.k), r.text) for r in out.filter("k BETWEEN 50 AND 99 OR k IS NULL").collect() if r.k != 51)
    assert got == sorted([("50", "[NAME] alone"), ("50", "[NAME] alone"), ("52", "ask Quimbys or quimby"), ("53", "[NAME] [NAME] 77"),
                          ("54", "[EMAIL]"), ("60", None), ("61", ""), ("None", "[NAME] alone")], key=str)
    assert out.filter("k = 51").first().text.endswith(" one [NAME].")
