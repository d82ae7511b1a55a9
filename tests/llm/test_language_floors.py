"""Texts of no learned language are rejected, clean short ones are not."""

import base64
import random

from framelark.llm import language
from pyspark.sql import functions as F

TABLE = "/root/testdata/sf0.01/documents.parquet"
FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다.",
]


def gibberish():
    rng = random.Random(3)
    words = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(6)) for _ in range(30)) for _ in range(3)]
    return [*words, base64.b64encode(rng.randbytes(300)).decode(), "a" * 500]


def test_unlearned_languages_are_rejected_and_short_texts_stay(spark):
    docs = spark.read.parquet(TABLE).select("doc_id", "text", "lang")
    model = language.fit(docs.filter("doc_id % 4 != 1"))
    assert model.predict(FOREIGN + gibberish())["rejected"].all()
    held = [r.text for r in docs.filter("doc_id % 4 = 1 and lang is not null").collect() if language.has_letter(r.text)]
    assert model.predict(held)["rejected"].mean() <= 0.02
    for chars in (24, 60, 200):
        begun = [b for t in held if language.has_letter(b := t[:chars])]
        assert model.predict(begun)["rejected"].mean() <= 0.03


def test_without_labels_all_texts_with_letters_are_kept(spark):
    docs = spark.createDataFrame([("one text", None), ("...", None)], "text string, lang string")
    found = docs.select("text", language.predicted(language.fit(docs)).alias("p")).collect()
    assert {r.text: (r.p.lang_pred, r.p.rejected) for r in found} == {"one text": ("und", False), "...": ("und", True)}


def test_copies_of_one_text_do_not_fill_the_sample(spark):
    rng = random.Random(5)
    words = "the of and that was with over under hand thing stone river".split()
    rows = [(" ".join(rng.choice(words) for _ in range(30)), "en") for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    copied = docs.orderBy(F.xxhash64("text")).first()["text"]
    many = docs.unionByName(spark.createDataFrame([(copied, "en")] * 200, docs.schema))
    assert len(language.fit(many, sample=40).langs) == len(language.fit(docs, sample=40).langs) > 1
