"""Benchmark items that single odd values, few literal words or the text before them must not hide."""

from __future__ import annotations

from casefile.llm import decontaminate


def found(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["item_ids"] for r in decontaminate.contamination(docs, bench).orderBy("doc_id").collect()]


PASSAGE = " ".join(
    f"then the {a} clerk named Anna counted 31 boxes of {b} and wrote all of it into the {c} book" for a, b, c in
    [("young", "tea", "red"), ("old", "salt", "blue"), ("tired", "rice", "green"), ("happy", "corn", "grey"), ("quiet", "wool", "black")]
)


def test_one_changed_value_does_not_hide_a_long_passage(spark):
    changed = PASSAGE[::-1].replace("Anna"[::-1], "Berta"[::-1], 1)[::-1]
    merged = PASSAGE.replace("31", "17", 4).replace("31", "55").replace("Anna", "Clara")
    item = "the shop sold 12 baskets of ripe plums in the morning and later that same day 45 jars of sweet honey were sold to people from the village"
    equal = item.replace("12", "70").replace("45", "70")
    assert found(spark, [PASSAGE, item], ["So: " + changed, "So: " + merged, equal, PASSAGE, "nothing of the kind is in this text at all"]) == [[0], [0], [1], [0], []]


def test_items_rich_in_values_are_found_as_they_are(spark):
    items = ["Compute 12 + 35 + 47 + 89", "Oslo 12 Bergen 15 Narvik 18 Hamar 21 Molde 24 Tromsø 27", "first 3 7 1 9 2 8 then"]
    texts = [f"Some words before . {i} and some behind" for i in items] + [items[0].replace("35", "36"), items[1].replace("1", "3").replace("2", "4")]
    assert found(spark, items, texts) == [[0], [1], [2], [], []]


def test_short_items_are_found_behind_any_words(spark):
    items = ["What is the capital of that land", "Anna 3 was here"]
    before = ["he asked ", "(", "\u201c", "Q ", "Stop. ", "Q: ", ""]
    texts = [b + items[0] for b in before] + ["as said Anna 3 was here", "what is the name of that land"]
    assert found(spark, items, texts) == [[0]] * len(before) + [[1], []]
