import re

from pyspark.sql import functions as F

from fieldgauge.llm import surrogates as P


def replaced(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in P.pseudonymise(df, **options).orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def test_formats_types_and_coreference(spark):
    rows = replaced(spark, [
        "write Ann.Lee@mail.example.com or ann.lee@mail.example.com, not bob@mail.example.com",
        "call +1 (743) 555-3824 or +1 743-555-3824", "card 4785380592391139 or 4785 3805 9239 1139", "host 152.143.123.131.",
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "id 123-45-6789",
        "Mr. John Smith met Mrs. Anna Smith, Herr Smith and Mr Иван Петров",
    ])
    texts = [r["text"] for r in rows]
    a, b, c = re.findall(r"[\w.]+@[\w.]+", texts[0])
    assert a.lower() == b != c and a.split("@")[1].lower() == c.split("@")[1] and a[0].isupper() and a.split(".")[-1] == "com"
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \+1 \d{3}-\d{3}-\d{4}", texts[1])
    first, second = texts[1][5:].split(" or ")
    assert re.sub(r"\D", "", first) == re.sub(r"\D", "", second) != "17435553824"
    one, two = re.findall(r"\d[\d ]+\d", texts[2])
    assert one == two.replace(" ", "") != "4785380592391139" and luhn(one) and two.count(" ") == 3
    assert all(0 < int(o) < 256 for o in texts[3][5:-1].split(".")) and "152.143" not in texts[3]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', texts[4]) and "24be" not in texts[4]
    assert re.fullmatch(r"id \d{3}-\d{2}-\d{4}", texts[5]) and "45-6789" not in texts[5]
    him, her, family, russian = re.fullmatch(r"Mr\. (\w+ \w+) met Mrs\. (\w+ \w+), Herr (\w+) and Mr (\w+ \w+)", texts[6]).groups()
    assert him.split()[1] == her.split()[1] != "Smith" and him.split()[0].endswith(("an", "or")) and her.split()[0].endswith(("a", "ine"))
    assert re.fullmatch("[А-Я][а-я]+ [А-Я][а-я]+", russian)
    assert [r["n_replaced"] for r in rows] == [3, 2, 2, 1, 1, 1, 4]


def test_what_only_looks_like_an_entity_stays(spark):
    texts = ["number 2123465659789240 and 4785380592391138", "v1.2.3.4.5 300.1.2.3 12.5", "@ at @@ a@b", "Mrs and Mr", "key: value", "plain. text", "", "2024-01-02 10:20:30"]
    rows = replaced(spark, texts)
    assert [r["text"] for r in rows] == texts and not any(r["n_replaced"] for r in rows)


def test_cards_among_other_digits(spark):
    card, spaced = "4111111111111111", "4111 1111 1111 1111"
    cases = [(f"a {spaced} 123.", spaced), (f"{card} 12/27", card), (f"12 {card}", card), (f"2024-12-01 {spaced} 7", spaced), (f"12-{card}", card),
             (f"{card}-737 x", card), ("378282246310005 1234", "378282246310005"), (f"{spaced} 2nd", spaced)]
    others = [f"{card} 152.143.123.131", f"{card} 123-45-6789", f"{card} 555-123-4567", f"{spaced} 5555 5555 5555 4444", f"{card}-5555555555554444"]
    rows = replaced(spark, [t for t, _ in cases] + others + ["1234 5678 " * 300])
    for (text, found), row in zip(cases, rows):
        before, after = text.split(found)
        made = row["text"][len(before) : len(before) + len(found)]
        assert row["n_replaced"] == 1 and row["text"] == before + made + after and made != found and luhn(re.sub(r"\D", "", made)), text
    for text, row in zip(others, rows[len(cases) :]):
        assert row["n_replaced"] == 2 and not any(part in row["text"] for part in (card, spaced, "152.143", "45-6789", "123-4567", "5555")), text


def test_whole_names_and_addresses(spark):
    names = ["Mr McDonald", "Ms Anna Smith-Jones", "Mrs O'Brien", "Mr J. Smith", "Sir J.R. Smith", "Herr Jean-Luc O’Neill-McKay", "Frau D'Arcy"]
    mails = ["_john@example.com_", "-john@example.com", "...john@example.com", "+john@example.com"]
    rows = replaced(spark, [f"met {n}, then" for n in names] + [f"to {m} now" for m in mails] + ["Mr Smith's and Mr Smith. I"])
    for name, row in zip(names, rows):
        title, *parts = name.split(" ")
        made = re.fullmatch(rf"met {title} ((?:[A-Z][a-z]+ ?)+), then", row["text"])
        assert made and row["n_replaced"] == 1 and not set(re.findall(r"\w{2,}", " ".join(parts))) & set(made[1].split()), row["text"]
    made = [re.fullmatch(r"to ([_.+-]*)([a-z]{4}@[a-z]{7}\.com)(_?) now", r["text"]) for r in rows[len(names) : -1]]
    assert all(made) and [m[1] + "john@example.com" + m[3] for m in made] == mails and len({m[2] for m in made}) == 1 and made[0][2] != "john@example.com"
    one, two = re.fullmatch(r"Mr (\w+)'s and Mr (\w+)\. I", rows[-1]["text"]).groups()
    assert one == two != "Smith"


def test_distinct_entities_get_distinct_surrogates(spark):
    numbers = [f"{i:03d}-11-{i:04d}" for i in range(400)]
    made = re.findall(r"\d{3}-\d{2}-\d{4}", " ".join(r["text"] for r in replaced(spark, [f"id {n}" for n in numbers])))
    assert len(set(made)) == 400 and not set(made) & set(numbers)


def test_clashes_draw_again(spark, monkeypatch):
    # Of three digits the first stays: few draws, many clashes.
    found = spark.createDataFrame([("ssn", f"1{i:02d}") for i in range(30)], "kind string, norm string")
    settled = P.settle(found, "k").collect()
    made = [r["made"] for r in settled]
    assert len(set(made)) == 30 and not set(made) & {f"1{i:02d}" for i in range(30)} and any(r["attempt"] for r in settled)
    # All draws are entities: the space widens by a digit instead.
    full = [f"1{i}" for i in range(10)]
    made = [r["made"] for r in P.settle(spark.createDataFrame([("ssn", n) for n in full], "kind string, norm string"), "k").collect()]
    assert len(set(made)) == 10 and not set(made) & set(full)


def test_late_draws_reach_the_texts(spark, monkeypatch):
    real = P.settle

    def third_draw(found, key, attempts=30):
        return real(found, key, attempts).withColumn("attempt", F.lit(2))

    text = "id 123-45-6789"
    first = replaced(spark, [text])[0]["text"]
    monkeypatch.setattr(P, "settle", third_draw)
    late = replaced(spark, [text, "none", None])
    assert late[0]["text"] not in (first, text) and late[1]["text"] == "none" and late[2]["text"] is None


def test_key_decides(spark):
    one, two = (replaced(spark, ["mail ann@b.example.com"], key=k)[0]["text"] for k in ("a", "b"))
    assert one != two and one == replaced(spark, ["mail ann@b.example.com"], key="a")[0]["text"]


def test_edges(spark, documents):
    odd = documents([(None, None, None, None), (1, "", None, None), (2, "a@b.example.com " * 2 + "w " * 50_000 + "x" * 100_000 + "1" * 50_000, None, None), (2, "8.8.8.8", None, None), (2, "8.8.8.8", None, None)])
    rows = P.pseudonymise(odd.withColumn("N_Replaced", F.lit("mine"))).collect()
    assert sorted(r["n_replaced"] for r in rows) == [0, 0, 1, 1, 2]
    assert len({r["text"] for r in rows if r["text"] and len(r["text"]) < 20}) == 1
    assert P.pseudonymise(documents([])).count() == 0


def test_no_python_in_the_plan(documents):
    plan = P.pseudonymise(documents([(1, "8.8.8.8", None, None)]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def rewritten(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["text"], r["n_replaced"]) for r in P.pseudonymise(df).collect()}


def test_letters_of_any_script_are_replaced(spark):
    texts = ["李@例子.cn here", "李小龙@example.com", "علي@example.com", "łukasz@example.com", "דוד@example.com", "ლევან@example.com", "한국@example.com"]
    for i, (text, n) in rewritten(spark, *texts).items():
        assert n == 1 and "@" in text
        local = texts[i].split("@")[0]
        new = text.split("@")[0]
        assert len(new) == len(local) and sum(a == b for a, b in zip(local, new)) <= len(local) // 2, text


def test_a_dense_space_widens(spark):
    """All one-letter addresses of a domain, twice over in two cases: 26 entities, 26 surrogates, none of them real."""
    texts = [f"{c}@x.com and {c.upper()}@X.com" for c in "abcdefghijklmnopqrstuvwxyz"]
    found = rewritten(spark, *texts)
    pairs = [text.lower().split(" and ") for text, n in found.values() if n == 2]
    assert len(pairs) == 26 and all(a == b for a, b in pairs)
    assert len({a for a, _ in pairs}) == 26 and not {a for a, _ in pairs} & {f"{c}@x.com" for c in "abcdefghijklmnopqrstuvwxyz"}


def test_long_addresses_and_secrets_are_replaced(spark):
    local, secret = "a" * 70, "x1" * 70
    found = rewritten(spark, f"to {local}@example.com", f'token = "{secret}"')
    assert local not in found[0][0] and secret not in found[1][0] and found[0][1] == found[1][1] == 1


def test_columns_named_like_inner_ones_stay(spark):
    df = spark.createDataFrame([("j@x.org", "f", "l", "p", "r")], "text string, _found string, _late string, _print string, _row string")
    (row,) = P.pseudonymise(df).collect()
    assert tuple(row)[1:5] == ("f", "l", "p", "r") and row["text"] != "j@x.org" and row["n_replaced"] == 1
