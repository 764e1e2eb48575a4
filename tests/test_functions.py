"""Hand-derived cases of the text functions, gates, masks and the glossary."""

import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmill.functions import gates, glossary, mask, text
from quillmill.functions.values import CAPITAL_STOP_WORDS, NEWS_TERMS
from quillmill.plans.translate import mask_all, with_masks


def evaluate(spark, function, *rows):
    """function of columns a, b and so on for each row, in one job."""
    rows = [r if isinstance(r, tuple) else (r,) for r in rows]
    names = "abc"[: len(rows[0])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{c} string" for c in names))
    return [r["x"] for r in df.select("i", function(*[F.col(c) for c in names]).alias("x")).orderBy("i").collect()]


def test_word_lists():
    assert len(set(CAPITAL_STOP_WORDS)) == 86 and len(set(NEWS_TERMS)) == len(NEWS_TERMS)


NUMBERS = {"1,000": ["1000"], "1,00,000": ["000", "100"], "10.50 and 10.5": ["10.5"], "3.00": ["3"], "0.0": ["0"], "1.2.3": ["1.2", "3"], "१०": ["१०"], None: [], "": [], "no": []}


def test_numbers(spark):
    assert evaluate(spark, text.numbers, *NUMBERS) == list(NUMBERS.values())


NAMES = {"Narendra Modi met The Court in New Delhi": ["Delhi", "Modi", "Narendra"], "Al": [], "Foo-9 Mid-Day ABा éAB x": ["Foo-", "Mid-Day"], None: []}


def test_names(spark):
    assert evaluate(spark, text.names, *NAMES) == list(NAMES.values())


SENTENCES = {
    'He came. She left! "Ok" no. now': ["He came.", "She left!", '"Ok" no. now'],
    "A. __NOUN_0__ b.": ["A. __NOUN_0__ b."],
    " **Bold.** Next ": ["Bold.", "Next"],
    "It’s 5. (Yes)": ["It's 5.", "(Yes)"],
    None: [],
    " \t\n": [],
}


def test_sentences(spark):
    assert evaluate(spark, text.sentences, *SENTENCES) == list(SENTENCES.values())
    assert evaluate(spark, text.simple_sentences, "no. now", "a.b", None) == [["no.", "now"], ["a.b"], []]


def test_titles(spark):
    assert evaluate(spark, text.title_fallback, "एक। दो।", "।abc" + "x" * 100, None) == ["एक", "।abc" + "x" * 76, ""]
    assert evaluate(spark, text.title_trim, " \"'abc।' ", "a'b", None) == ["abc", "a'b", ""]
    assert evaluate(spark, text.quote_strip, '"a"', "''a", "a", None) == ["a", "'a", "a", ""]


def test_number_gate(spark):
    got = evaluate(spark, gates.number_gate, ("5 of 10", "10"), ("5", "5 6"), (None, None))
    assert [(g.number_ok, g.numbers_missing, g.numbers_extra) for g in got] == [(False, ["5"], []), (True, [], ["6"]), (True, [], [])]


def test_script_gate(spark):
    got = evaluate(spark, gates.script_gate, "abc अब é", "жаж", "—₹1؟", None)
    assert [(g.script_ok, g.bad_chars) for g in got] == [(True, ""), (False, "аж"), (True, ""), (True, "")]


def test_entity_gate(spark):
    five = "Aaaa Bbbb Cccc Dddd Eeee"
    got = evaluate(spark, lambda a, b: gates.entity_gate(a, b, None, off=False), (five, "aaaa bbbb cccc DDDD"), (five, "aaaa bbbb cccc"), ("", ""), (None, None))
    assert [(g.entity_ok, g.entities_missing) for g in got] == [(True, ["Eeee"]), (False, ["Dddd", "Eeee"]), (True, []), (True, [])]
    assert evaluate(spark, lambda a, b: gates.entity_gate(a, b), (five, ""))[0].entity_ok


def test_back_translation_is_pruned_when_the_gate_is_off(spark):
    df = spark.createDataFrame([("a", "b")], "en string, hi string").withColumn("back", F.udf(lambda x: x)("hi"))
    plan = df.select(gates.verify(F.col("en"), F.col("hi"), F.col("back"), off=True))._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan


def masks(spark, function, *rows):
    return [(m.text, [(e.placeholder, e.original) for e in m.entries]) for m in evaluate(spark, lambda a: function(mask.unmasked(a)), *rows)]


def test_mask_times(spark):
    assert masks(spark, mask.mask_times, "Meet at 10.21 am today", "CPI rose 2.45 percent", "12.75 13.20", None) == [
        ("Meet at __TIME_0__ today", [("__TIME_0__", "10:21 am")]),
        ("CPI rose __TIME_0__percent", [("__TIME_0__", "2:45 ")]),
        ("12.75 13.20", []),
        ("", []),
    ]


def test_mask_money(spark):
    assert masks(spark, mask.mask_money, "Rs 50 lakh fine", "₹50,000", "eur 3.5 Crore", "$5x") == [
        ("__MONEY_0__ fine", [("__MONEY_0__", "Rs 50 lakh")]),
        ("__MONEY_0__,000", [("__MONEY_0__", "₹50")]),
        ("__MONEY_0__", [("__MONEY_0__", "eur 3.5 Crore")]),
        ("$5x", []),
    ]


def test_mask_nouns(spark):
    assert masks(spark, mask.mask_nouns, "Narendra Modi met New Delhi Police", "Aa Bb and Aa Bb Cc") == [
        ("__NOUN_0__ met New Delhi Police", [("__NOUN_0__", "Narendra Modi")]),
        ("__NOUN_1__ and __NOUN_0__", [("__NOUN_0__", "Aa Bb Cc"), ("__NOUN_1__", "Aa Bb")]),
    ]


def test_mask_terms(spark):
    assert masks(spark, mask.mask_terms, "Budget and budget", "the Police Team", "taxi") == [
        ("__NOUN_0__ and budget", [("__NOUN_0__", "Budget")]),
        ("the __NOUN_0__", [("__NOUN_0__", "Police Team")]),
        ("taxi", []),
    ]


def naive_masks(text, start=0):
    """Names, then terms, each with a pattern of its own over the whole text."""
    word = r"[\p{L}\p{N}_]"
    edge = rf"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))"
    found = regex.findall(rf"{edge}[A-Z][a-zA-Z.]+(?:\s+[A-Z][a-zA-Z.]+)+{edge}", text)
    names = sorted({x for x in found if regex.match("[a-zA-Z.]+", x)[0] not in CAPITAL_STOP_WORDS}, key=lambda x: (-len(x), x))
    entries = []

    def put(x):
        nonlocal text
        text = regex.sub(edge + regex.escape(x) + edge, lambda _: f"__NOUN_{start + len(entries)}__", text)
        entries.append((f"__NOUN_{start + len(entries)}__", x))

    for x in names:
        put(x)
    for x in sorted(set(NEWS_TERMS), key=lambda x: (-len(x), x)):
        m = regex.search(f"(?ia:{edge}{regex.escape(x)}{edge})" if x.isascii() else "$^", text) if x in text.lower() else None
        if m:
            put(m[0])
    return text, entries


def test_masks_of_documents_by_brute_force(spark, sf_dir):
    odd = ["The Aa Bb Cc. Aa Bb and Bb Cc Dd, The Aa Bb Cc Dd", "x.Aa Bb Aa  Bb\u2003Cc", "apps App app APP", "", "In An On At", "Aa Bbé Aa Bb", "5G 5g 5G5G"]
    docs = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + odd
    turns = [" ".join(NEWS_TERMS[k : k + 7]).title() + ". The " + " ".join(NEWS_TERMS[k : k + 3]) for k in range(0, len(NEWS_TERMS), 5)]
    rows = docs + turns
    assert masks(spark, mask.mask_nouns_and_terms, *rows) == [naive_masks(x or "") for x in rows]


def test_all_masks_share_one_index(spark):
    said = "Asha Rao paid $5 million at 10.30 am for the stock market app"
    df = with_masks(spark.createDataFrame([(said,)], "t string"), "t", "m").select("m.*").first()
    assert df.text == "__NOUN_2__ paid __MONEY_1__ at __TIME_0__ for the __NOUN_3__ __NOUN_4__"
    assert [e.original for e in df.entries] == ["10:30 am", "$5 million", "Asha Rao", "stock market", "app"]
    assert evaluate(spark, mask_all, said)[0].text == df.text


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="Ab .$5019:amRs\\$E\n", max_size=40), min_size=20, max_size=40))
def test_unmask_restores_all_but_the_dots_of_times(spark, texts):
    def both(a):
        m = mask.mask_nouns(mask.mask_money(mask.unmasked(a)))
        return mask.unmask(m["text"], m["entries"])

    assert evaluate(spark, both, *texts) == texts


def test_glossary(spark):
    police = {"पुलिस": "police"}
    assert evaluate(spark, lambda a: glossary.apply_glossary(a, police), "पुलिस पुलिसवाला", "पुलिस।", None) == ["police पुलिसवाला", "पुलिस।", ""]
    assert evaluate(spark, lambda a: glossary.apply_glossary(a, {}), "a \t b ") == ["a b"]
    assert evaluate(spark, lambda a: glossary.apply_glossary(a, {"क": "$1\\", "क ख": "long"}), "क ख क") == ["long $1\\"]


LOANS = {("कारण", "reason"): True, ("रूप", "form"): False, ("करने", "to do"): False, ("जनता", ""): True, ("फल", "fruit"): True, ("पुलिस", "x"): True, ("न", "no"): False, ("है।", "is"): False}


def test_loans(spark):
    assert evaluate(spark, glossary.looks_loan, *LOANS) == list(LOANS.values())
    assert evaluate(spark, glossary.suggested_latin, ("पुलिस", "force"), ("कारण", " Reason "), ("रूप", "form")) == ["police", "reason", ""]


@pytest.mark.parametrize("token, n", [("है।", 3), ("ab", 0)])
def test_target_tokens(spark, token, n):
    assert [len(x) for x in evaluate(spark, text.target_tokens, token)[0]] == ([n] if n else [])
