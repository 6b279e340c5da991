"""Rule engine and classifiers."""

import pytest
from pyspark.sql import functions as F

from venuelake.operators import classify as cl
from venuelake.operators import rules as rule_module
from venuelake.operators.rules import first_match

RULES = [("SYSCO", "2. COGS/Food COGS", "Sysco"), ("RENT", "5. OPEX/Rent", "Landlord"), ("RENT A CAR", "5. OPEX/Travel", "Car Hire")]
REGISTER = [("1234", "Sysco Foods", "2. COGS/Food", "Sysco Reg"), ("5678", "Nobody", "", ""), ("777", "Sysco Houston", "", "")]


def categorize(spark, texts):
    bank = spark.createDataFrame([(t,) for t in texts], "description string")
    out = cl.categorize_bank(bank, spark.createDataFrame(RULES, "keyword string, category string, vendor_normalized string"),
                             spark.createDataFrame(REGISTER, "check_number string, payee string, category string, vendor_normalized string"))
    return {r.description: (r.category, r.category_source, r.vendor_normalized) for r in out.collect()}


def test_categorizer_answers(spark):
    cases = {
        "TOAST DES:DEP 240115": ("1. Revenue/Sales Revenue", "auto", "Toast Deposit"),
        "TOAST DES:EOM": ("1. Revenue/Sales Revenue", "auto", "Toast EOM Adjustment"),
        "Toast, Inc DES:Toast": ("5. Operating Expenses (OPEX)/POS & Technology Fees", "auto", "Toast Platform Fee"),
        "TOAST DES:REF": ("5. Operating Expenses (OPEX)/POS & Technology Fees", "auto", "Toast Refund"),
        "TOAST, INC. DES:20250115": ("1. Revenue/Sales Revenue", "auto", "Toast Settlement"),
        "ACH Debit SYSCO CORP ID:1": ("2. COGS/Food COGS", "auto", "Sysco"),
        "SYSCOM PARTS": ("Uncategorized", "uncategorized", "SYSCOM PARTS"),
        "RENT A CAR CENTER": ("5. OPEX/Travel", "auto", "Car Hire"),
        "Check 1234": ("2. COGS/Food", "check_register", "Sysco Reg"),
        "Check 777": ("2. COGS/Food COGS", "check_register", "Sysco"),
        "Check 9999": ("Uncategorized", "uncategorized", "Check 9999"),
        "Check 5678": ("Uncategorized", "uncategorized", "Nobody"),
        "WIRE TYPE:WIRE OUT BNF:ACME INC ID:9": ("Uncategorized", "uncategorized", "ACME INC"),
        "mystery": ("Uncategorized", "uncategorized", "mystery"),
    }
    assert categorize(spark, list(cases)) == cases


@pytest.mark.parametrize("mode", ["contains", "word"])
def test_first_rule_in_text(spark, mode):
    texts = [("alpha beta",), ("alphabet",), ("the beta-max",), ("x$ACE y",), (None,), ("",), ("gamma",)]
    df = spark.createDataFrame(texts * 3, "t string")
    rules = spark.createDataFrame([("beta", 2, "B"), ("alpha", 1, "A"), ("$ace", 3, "C"), ("gam", 4, "D")], "keyword string, priority int, label string")
    got = first_match(df, rules, "t", ["label"], mode=mode).collect()
    assert len(got) == len(texts) * 3
    expected = {"alpha beta": "A", "alphabet": "A" if mode == "contains" else None, "the beta-max": "B", "x$ACE y": "C", "gamma": "D" if mode == "contains" else None, "": None, None: None}
    assert {r.t: r.label for r in got} == expected


def test_blank_keywords_and_ties(spark):
    df = spark.createDataFrame([("abc",), ("zzz",), (None,)], "t string")
    rules = spark.createDataFrame([("", 0, "E"), ("  ", 0, "E"), (None, 0, "E"), ("bc", 1, "A"), ("ab", 1, "Z"), ("ab", 1, "Y")], "keyword string, priority int, label string")
    assert {r.t: r.label for r in first_match(df, rules, "t", ["label"]).collect()} == {"abc": "Y", "zzz": None, None: None}
    assert {r.t: r.label for r in first_match(df, rules.limit(0), "t", ["label"]).collect()} == {"abc": None, "zzz": None, None: None}


def test_rule_on_equal_column(spark):
    df = spark.createDataFrame([("live set", 4), ("live set", 3), ("live set", None)], "t string, d int")
    rules = spark.createDataFrame([("live", 1, 4, "fri"), ("live", 0, None, "null")], "keyword string, priority int, day int, key string")
    got = {(r.t, r.d): r.key for r in first_match(df, rules, "t", ["key"], equal={"day": "d"}).collect()}
    assert got == {("live set", 4): "fri", ("live set", 3): None, ("live set", None): None}


def test_empty_register_leaves_checks_to_the_rules(spark):
    bank = spark.createDataFrame([("Check 55",)], "description string")
    rules = spark.createDataFrame([("CHECK", "Checks", "V")], "keyword string, category string, vendor_normalized string")
    none = spark.createDataFrame([], "check_number string, payee string, category string, vendor_normalized string")
    assert cl.categorize_bank(bank, rules, none).first().category == "Checks"


@pytest.mark.parametrize("reason, bucket", [
    ("Manager Comp - Check (100.00%)", "discretionary_manager"), ("Birthday Comp", "programmatic_birthday"), ("Owner Comp-Check", "owner_discretion"),
    ("Employee Discount - Item", "employee"), ("Open $ Check", "uncategorized_open_dollar"), ("Open % Item", "uncategorized_open_pct"), ("Spillage", "recovery"), ("odd", "other"), (None, "other"),
])
def test_comp_reason(spark, reason, bucket):
    df = spark.createDataFrame([(reason,)], "r string")
    assert df.select(cl.comp_reason(F.col("r"))).first()[0] == bucket


def test_comp_precedence(spark):
    rows = [("Bday F - ann", "OWNER MOET", "Manager Comp", "programmatic_birthday"), (None, "OWNER MOET", "Manager Comp", "owner_discretion"), ("Table 4", "Wings", "Spillage", "recovery"),
            ("per pat table", "Wings", "Spillage", "owner_discretion"), ("pat tasting", "Wings", "Spillage", "recovery"), ("VIP - x", "Bday cake", None, "vip"), ("bottle broke", "x", "Owner Comp", "recovery")]
    df = spark.createDataFrame(rows, "tab string, item string, reason string, expected string")
    got = df.select("expected", cl.comp_final(cl.comp_tab(F.col("tab"), ["pat"]), cl.comp_item(F.col("item")), cl.comp_reason(F.col("reason"))).alias("b")).collect()
    assert [r.b for r in got] == [r.expected for r in got]


def test_prime_grades_and_segments(spark):
    from venuelake.rulebook import PRIME_GRADES
    df = spark.createDataFrame([(54.9,), (55.0,), (60.0,), (65.0,)], "p double")
    assert [r[0] for r in df.select(cl.step_grade(F.col("p"), PRIME_GRADES, "Investigate")).collect()] == ["Excellent", "Good", "Elevated", "Investigate"]
    g = spark.createDataFrame([(12, 10), (12, 60), (6, 40), (4, 60), (2, 10), (1, 10), (1, 50), (20, 91)], "v int, r int")
    assert [r[0] for r in g.select(cl.guest_segment(F.col("v"), F.col("r"))).collect()] == ["champions", "loyal", "regulars", "at_risk", "returning", "new", "dormant", "dormant"]


@pytest.mark.parametrize("repeated", [True, False])
def test_long_texts_and_many_keywords(spark, repeated):
    """Whole long texts against brute force: keywords shorter and longer than a prefix and a piece, at every place."""
    import random

    rng = random.Random(5)
    letters = "abé \U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([3, 60, 127, 128, 129, 300, 2000]))) for _ in range(60)]
    texts += texts[:5] + ["x" * 127 + "needle in a stack" + "y" * 400, None, ""]
    words = {"".join(rng.choice(letters) for _ in range(n)) for n in (2, 4, 6, 8, 9, 12) for _ in range(12)}
    words |= {texts[0][:2] or "q", "needle in a stack", "y" * 390, texts[-4][:300]}
    rules = [(w, rng.randrange(40), f"r{i}") for i, w in enumerate(sorted(w for w in words if w.strip()))]
    got = first_match(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), spark.createDataFrame(rules, "keyword string, priority int, label string"), "t", ["label"], repeated=repeated).collect()
    assert len(got) == len(texts)
    want = {i: min(((p, w.strip().upper(), x) for w, p, x in rules if t and w.strip().upper() in t.upper()), default=(0, "", None))[2] for i, t in enumerate(texts)}
    assert {r.i: r.label for r in got} == want
    assert any(want.values()) and len(set(want.values())) > 5


def test_processor_and_deposit_rows_are_parameters(spark):
    bank = spark.createDataFrame([("ACME PAY DES:IN 1", 5.0), ("TOAST DES:DEP", 5.0), ("ACME PAY DES:IN 1", -5.0)], "description string, amount double")
    rules = spark.createDataFrame([], "keyword string, category string, vendor_normalized string")
    register = spark.createDataFrame([], "check_number string, payee string, category string, vendor_normalized string")
    got = {(r.description, r.amount): r.vendor_normalized for r in cl.categorize_bank(bank, rules, register, processor=[(["ACME", "DES:"], r"PAY DES:IN \d", "Sales", "Acme")]).collect()}
    assert got == {("ACME PAY DES:IN 1", 5.0): "Acme", ("ACME PAY DES:IN 1", -5.0): "Acme", ("TOAST DES:DEP", 5.0): "TOAST DES:DEP"}
    kinds = bank.select(cl.deposit_type(F.col("description"), F.col("amount"), [("ACME", True, 1, "settlement")]).alias("k"))
    assert sorted(str(r.k) for r in kinds.collect()) == ["None", "None", "settlement"]


def test_rows_are_not_shuffled_for_few_texts(spark):
    """Rows meet the hits of their texts as a small stored table, however many rows there are."""
    df = spark.range(0, 3_000_000, 1, 8).selectExpr("id", "concat('tab ', id % 20) AS t")
    got = first_match(df, spark.createDataFrame([("b 1", 1, "X")], "keyword string, priority int, label string"), "t", ["label"])
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.groupBy("label").count().where("label = 'X'").first()["count"] == 11 * 150_000


def test_places_that_begin_no_keyword_do_not_travel(spark):
    import random

    rng = random.Random(31)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    # Many keywords and texts that share their first letters with keywords but hold few whole ones.
    keywords = sorted({word(9) + word(rng.randint(0, 6)) for _ in range(3000)})
    texts = [" ".join(rng.choice(keywords)[:8] + word(6) for _ in range(30)) for _ in range(200)] + [f"{word(90)}{k}{word(90)}" for k in keywords[:50]] + [None, "", "é" * 40]
    rules = spark.createDataFrame([(k, k, i) for i, k in enumerate(keywords)], "keyword string, label string, priority int")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = {t: next((k for k in keywords if k in t), None) if t else None for t in texts}
    assert {r.t: r.label for r in rule_module.first_match(df, rules, "t", ["label"]).collect()} == want
    prepared = rules.select(F.upper("keyword").alias("_rk"), F.upper(F.substring("keyword", 1, rule_module.PREFIX)).alias("_k"))
    places = rule_module._hit_places(df.where("t is not null").select(F.col("t").cast("binary").alias("_j"), F.upper("t").alias("_t")), prepared)
    hits = sum(t[i : i + n].lower() in set(keywords) for t in texts if t for i in range(len(t)) for n in range(9, 16) if i + n <= len(t))
    assert hits <= places.count() <= 1.5 * hits + 600
