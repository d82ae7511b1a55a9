"""Documents may have columns with any names: no stage overwrites, drops or trips over them."""

import corpus_pipeline
import pytest
from framelark.llm import language
from framelark.llm.bytegrams import has_letter

NAMES = (
    "_id _hash _rows _row_hash _copies _copy _values _key _ID __id row_hash class_id class_key digest lang_pred score "
    "rejected copies taken size target source_size bucket bands root node _class _least a.b with`tick"
).split()


def documents(spark, n=60):
    words = "the of and that was with over under hand thing stone river der die und nicht haus zeit".split()
    rows = []
    for i in range(n):
        text = " ".join(words[(i * 7 + k * k) % len(words)] for k in range(12 + i % 9)) + (" mail a.b@c.de" if i % 4 == 0 else "")
        rows.append((i // 2 * 2 if i % 10 == 1 else i, text if i % 13 else None, "en" if i % 2 else "de", f"s{i % 3}", *[f"{name}{i}" for name in NAMES]))
    rows += [rows[5], rows[5]]
    fields = ", ".join(["doc_id long, text string, lang string, source string", *[f"`{n.replace('`', '``')}` string" for n in NAMES]])
    return spark.createDataFrame(rows, fields)


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_other_columns_come_through_untouched(spark, stage):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        docs = documents(spark).cache()
        run = dict(corpus_pipeline.STAGES)[stage]
        found = run(spark, docs, "")
        if stage == corpus_pipeline.STAGES[-1][0]:
            assert {r.doc_id for r in found.collect()} == {r.doc_id for r in docs.collect()}
            return
        assert found.columns == docs.columns
        places = [docs.columns.index(n) for n in NAMES]
        before = {tuple(r[p] for p in places) for r in docs.collect()}
        after = [tuple(r[p] for p in places) for r in found.collect()]
        assert after and set(after) <= before
        texts = {r[places[0]]: r.text for r in docs.collect()}
        changed = [r for r in found.collect() if r.text != texts[r[places[0]]]]
        assert bool(changed) == (stage == "personal data")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_number_signs_are_no_letters(spark):
    for text in ("²", "½ ①", "Ⅷ", "৩", "", None, "12 _ 3", "😀", "〇"):
        assert not has_letter(text)
    for text in ("a", "²é", "ª", "ж", "中", "ꙮ", "ʰ"):
        assert has_letter(text)
    labelled = spark.createDataFrame([(f"the of and that {i}", "en") for i in range(20)], "text string, lang string")
    asked = spark.createDataFrame([("²",), ("½ ①",), ("Ⅷ",), ("the of",)], "text string")
    found = asked.select("text", language.predicted(language.fit(labelled)).alias("p")).collect()
    assert {r.text: (r.p.lang_pred, r.p.score > 0) for r in found} == {
        "²": ("und", False), "½ ①": ("und", False), "Ⅷ": ("und", False), "the of": ("en", True),
    }
