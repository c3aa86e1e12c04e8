"""Pseudonyms: against a plain Feistel, round trip, validity, and no personal value left."""

import hashlib
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from aeroloom.llm import pseudonyms, queries
from tests.llm.conftest import SF

KEY = "k"


def luhn_ok(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def feistel(index, a, b, tag):
    left, right = divmod(index, b)
    for k in range(pseudonyms.ROUNDS):
        half = right if k % 2 == 0 else left
        h = int(hashlib.sha256(f"{KEY}|{tag}|{k}|{half}".encode()).hexdigest()[:13], 16)
        if k % 2 == 0:
            left = (left + h % a) % a
        else:
            right = (right + h % b) % b
    return left * b + right


def run(docs_of, texts):
    rows = pseudonyms.pseudonymise(docs_of(list(enumerate(texts))), KEY).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_numbers_follow_the_plain_feistel(spark):
    df = spark.range(200).withColumn("p", pseudonyms.permute(F.col("id"), 20, 10, KEY, "x")).withColumn("back", pseudonyms.permute(F.col("p"), 20, 10, KEY, "x", True))
    rows = df.collect()
    assert [r.p for r in rows] == [feistel(i, 20, 10, "x") for i in range(200)]
    assert sorted(r.p for r in rows) == list(range(200)) and all(r.back == r.id for r in rows)


def test_strings_are_permuted(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"))
    rows = df.withColumn("d", pseudonyms.permute_digits(F.col("s"), KEY, "x")).withColumn("c", pseudonyms.permute_string(F.col("s"), KEY, "x")).collect()
    assert len({r.d for r in rows}) == len({r.c for r in rows}) == 1000 and all(re.fullmatch("[0-9]{3}", r.d + "") and len(r.c) == 3 for r in rows)


def test_formats(docs_of):
    ip, day = "70.123.182.155", date(1999, 12, 31)
    got = run(docs_of, ["4041894974608795", "4041 8949 7460 8795", f"at {ip}.", "1999-12-31", "31.12.1999", "+1 (988) 555-2485", "988-555-2485", "123-45-6789",
                        "DE89370400440532013000", "a.b@mail.example.org", "password=e3b3ed3cc8548923d6"])
    assert luhn_ok(got[0]) and got[0][0] == "4" and got[1].replace(" ", "") == got[0] and got[1][4] == " "
    n = feistel(int.from_bytes(map(int, ip.split("."))), 65536, 65536, "ip")
    assert got[2] == "at " + ".".join(map(str, n.to_bytes(4))) + "."
    assert date.fromisoformat(got[3]).toordinal() - date(1900, 1, 1).toordinal() == feistel((day - date(1900, 1, 1)).days, 17, 4297, "date yyyy-MM-dd")
    assert re.fullmatch(r"[0-3]\d\.[01]\d\.(19|20)\d\d", got[4])
    assert re.sub(r"\D", "", got[5])[1:] == got[6].replace("-", "") and re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", got[5])
    assert re.fullmatch(r"\d{3}-\d\d-\d{4}", got[7]) and got[7] != "123-45-6789"
    moved = got[8][4:] + "1314" + got[8][2:4]
    assert got[8][:2] == "DE" and int(moved) % 97 == 1
    assert re.fullmatch(r"[a-z]\.[a-z]@[a-z]{4}\.[a-z]{7}\.org", got[9]) and re.fullmatch("password=[0-9a-f]{18}", got[10])


KEPT = [None, "", " \n", "clean text 4.0 version 3.", "4041894974608796", "300.1.1.1", "2020-02-30", "000-12-3456", "1.2.3.4.5", "x" * 200_000, "12345678901234567890123"]


def test_what_is_not_valid_stays(docs_of):
    assert run(docs_of, KEPT) == KEPT


def test_round_trip_and_other_columns(spark, docs_of):
    text = "Ä 4041894974608795, mail x.1@a9.example.com; +4915112345678 token: \"abcDEF123456\" 1.2.3.4 123-45-6789 31/12/1999\n" * 3
    docs = docs_of([(1, text), (1, text), (None, text), (2, None), (3, text * 50)]).withColumns({n: F.lit("clash") for n in ("found", "New", "between", "__found", "__new", "b", "n")})
    hidden = pseudonyms.pseudonymise(docs, KEY)
    assert hidden.columns == docs.columns and "4041894974608795" not in "".join(r.text or "" for r in hidden.collect())
    assert sorted(map(str, pseudonyms.pseudonymise(hidden, KEY, inverse=True).collect())) == sorted(map(str, docs.collect()))
    assert pseudonyms.pseudonymise(docs_of([]), KEY).collect() == []


@pytest.fixture(scope="module")
def private():
    return re.compile(r"[\w.%+-]+@[\w.-]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\w)\d{16}(?!\w)|(?<![\w.])\d+\.\d+\.\d+\.\d+|AKIA[A-Z0-9]{16}"
                      r"|(?:password=|token = \")[0-9a-f]+")


def test_query_hides_all_and_only_personal_data(spark, private):
    larger = SF.replace("sf0.001", "sf0.01")  # the smallest tables hold too few values
    got = {r.doc_id: r.text for r in queries.op2_pseudonyms(spark, larger).collect()}
    pairs = {}
    for r in queries.table(spark, larger, "documents").collect():
        before, after = private.findall(r.text), private.findall(got[r.doc_id])
        assert len(before) == len(after) and private.split(r.text) == private.split(got[r.doc_id])
        for a, b in zip(before, after):
            if re.fullmatch("[0-9]{16}", a) and not luhn_ok(a):  # not a card
                assert a == b
                continue
            assert a != b and pairs.setdefault(a, b) == b
    assert len(pairs) > 20 and len(set(pairs.values())) == len(pairs)


def test_no_python_in_the_plan(spark):
    plan = queries.op2_pseudonyms(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_spaced_ibans_and_phones(docs_of):
    texts = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "BE68-5390-0754-7034 EUR1", "GB29 NWBK 6016 1331 9268 19.", "+44 20 7946 0958", "+442079460958",
             "+49-151-1234567", "555 123 4567", "+1 555 123 4567", "555-123-4567", "(988) 055-2485", "DE00 4041 8949 7460 8795 00", "+49 151 1234567 123-45-6789"]
    got = run(docs_of, texts)
    assert all(a != b and re.sub("[0-9]", "0", re.sub("[A-Z]", "A", a)) == re.sub("[0-9]", "0", re.sub("[A-Z]", "A", b)) for a, b in zip(texts, got))
    assert got[0].replace(" ", "") == got[1] and got[4].replace(" ", "") == got[5] and got[7] == got[8][3:] == got[9].replace("-", " ")
    for text, country in ((got[0], "DE"), (got[2][:19], "BE"), (got[3][:-1], "GB")):
        plain = re.sub("[ -]", "", text)
        assert plain[:2] == country and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert got[2].endswith(" EUR1") and got[4].startswith("+44 ") and luhn_ok(re.sub(" ", "", got[11][5:24])) and got[12][-11:] == run(docs_of, ["123-45-6789"])[0]
    back = pseudonyms.pseudonymise(docs_of(list(enumerate(got))), KEY, inverse=True).collect()
    assert [r.text for r in sorted(back, key=lambda r: r.doc_id)] == texts
