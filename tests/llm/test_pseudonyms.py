"""Pseudonyms: validity, links across documents, the way back, and a plain Feistel network."""

from __future__ import annotations

import datetime
import hashlib
import re

from paxflow.llm.pseudonyms import CARD, ROUNDS, replace_values
from paxflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def luhn(s):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(s)) % 10 == 0


def permuted(value, sizes, key, kind):
    a, b = divmod(value, sizes[1])
    word = lambda i, x: int(hashlib.sha256(f"{key}|{kind}|{i}|{x}|{key}".encode()).hexdigest()[:15], 16)
    for i in range(ROUNDS):
        if i % 2 == 0:
            a = (a + word(i, b)) % sizes[0]
        else:
            b = (b + word(i, a)) % sizes[1]
    return a * sizes[1] + b


VALID = {
    "card": "4111111111111111",
    "phone": "+1 (323) 555-9830",
    "ip": "192.168.10.7",
    "ssn": "078-05-1120",
    "date": "2024-02-29",
    "email": "anna.Lee-77@mail6.example.com",
    "secret": "0a1b2c3d4e5f60718293a4b5c6d7e8f9",
}
INVALID = ["4111111111111112", "300.1.2.3", "000-12-3456", "666-12-3456", "2023-02-29", "2024-13-01",
           "1.2.3.4.5", "12345678901234567", "deadbeefdeadbeefdeadbeef", "a@b", "1799-12-31"]


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_values string, rewritten int")


def test_values_stay_valid_and_linked(spark):
    rows = [(i, f"x {v}. {v}, y", None, 1) for i, v in enumerate(VALID.values())]
    rows += [(20 + i, f"«{v}»\n{v}", "z", None) for i, v in enumerate(VALID.values())]
    out, count = replace_values(texts(spark, rows), "key")
    assert out.columns == ["doc_id", "text", "n_values", "rewritten", count] and count != "n_values"
    found = {r.doc_id: r for r in out.collect()}
    for i, (kind, value) in enumerate(VALID.items()):
        assert found[i][count] == found[20 + i][count] == 2, kind
        new = re.fullmatch(r"x (.*)\. (.*), y", found[i].text)
        assert new[1] == new[2] != value and found[20 + i].text == f"«{new[1]}»\n{new[1]}"
        new = new[1]
        assert len(new) == len(value) or kind == "ip"
        if kind == "card":
            body = f"{permuted(int(value[6:15]), CARD, 'key', 'card'):09d}"
            assert luhn(new) and new[:15] == value[:6] + body
        elif kind == "date":
            assert 1800 <= datetime.date.fromisoformat(new).year < 2200
        elif kind == "ip":
            assert all(0 <= int(x) <= 255 for x in new.split("."))
        elif kind == "phone":
            assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new)
        elif kind == "email":
            assert re.fullmatch(r"[a-z]{4}\.[A-Z][a-z]{2}-\d\d@mail6\.example\.com", new)
        elif kind == "secret":
            assert re.fullmatch("[0-9a-f]{32}", new)


def test_way_back(spark):
    rows = [(i, f"{v} and {v}", None, 1) for i, v in enumerate([*VALID.values(), "001-01-0001", "899-99-9999",
            "1800-01-01", "2199-12-31", "0.0.0.0", "255.255.255.255", "é.ö@x.org", "q@x.org", "+1 (017) 555-0000", "+49 (999)999-9999", "0A1B2C3D4E5F60718293A4B5C6D7E8F9"])]
    docs = texts(spark, rows)
    again, _ = replace_values(replace_values(docs, "k")[0].select(*docs.columns), "k", back=True)
    assert {r.doc_id: r.text for r in again.collect()} == {i: t for i, t, _, _ in rows}


def test_other_texts_are_left_alone(spark):
    rows = [(i, f"see {v} here", None, 1) for i, v in enumerate(INVALID)] + [(90, None, None, 1), (91, "", None, 1)]
    docs = texts(spark, rows)
    out, count = replace_values(docs, "k")
    assert {r.doc_id: (r.text, r[count]) for r in out.collect()} == {i: (t, 0) for i, t, _, _ in rows}
    assert replace_values(docs.limit(0), "k")[0].count() == 0


def test_query_hides_every_valid_value(spark):
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    after = {r.doc_id: r for r in QUERIES["op6_pseudonyms"](spark, SF_DIR).collect()}
    assert before.keys() == after.keys()
    shapes = r"\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\S+@\S+\.\w+|\b(?:\d{1,3}\.){3}\d{1,3}\b|\b(?=[a-f]*\d)(?=\d*[a-f])[0-9a-f]{20,}\b|\b(?=[A-F]*\d)(?=\d*[A-F])[0-9A-F]{20,}\b"
    for doc, text in before.items():
        values = [v for v in re.findall(shapes, text) if not re.fullmatch(r"\d{16}", v) or luhn(v)]
        assert not [v for v in values if v in after[doc].text]
        if not re.search(r"[0-9@]", text):
            assert after[doc].text == text and after[doc].n_values == 0


def test_long_texts_of_one_unit_do_no_harm(spark):
    units = ["a.", "x@a.", "1.", "1-", "0a"]
    rows = [(i, "x@" + u * (200_000 // len(u)) + " end", None, 1) for i, u in enumerate(units)]
    out, _ = replace_values(texts(spark, rows).repartition(4), "k")
    assert out.filter("length(text) > 190000").count() == len(rows)


def test_only_changed_values_count(spark):
    docs = texts(spark, [(1, "from иван@x.ru to q@x.org", None, 1)])
    out, count = replace_values(docs, "k")
    row = out.first()
    assert row[count] == 1 and "иван@x.ru" in row.text and "q@x.org" not in row.text
