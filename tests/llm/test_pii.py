from __future__ import annotations

import re

from pyspark.sql import functions as F

from terrace.llm.pii import dictionary, mentions, pseudonymise, pseudonymised, surrogate

from .helpers import ODD, no_docs, odd_docs

TEXTS = [
    "Mail Anna.Lee@Mail7.Example.com or ANNA.LEE@MAIL7.EXAMPLE.COM, not anna.lee@mail8.example.com; übér.9@x.org.",
    "Call +1 (017) 555-7713 or +1-017-555-7713 or (415) 555-2671; host 10.1.2.3 and 8.8.4.4, version 2.0.1, 300.1.1.1.",
    "Card 4111 1111 1111 1111 and 4111111111111111 and 1234567890123456; SSN 078-05-1120.",
    "Mrs. Eva Stone met Mr Stone and Frau Müller; г-н Иванов. Mrs. Eva Stone left. Sir, no name.",
    "4785380592391139$$$ token###97.51.17.173*** <a.b@c.de>",
    "nothing here at all",
]


def luhn(digits: str) -> bool:
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_texts_with_surrogates(spark):
    out = {r["doc_id"]: r for r in pseudonymised(frame(spark, TEXTS), "k").collect()}
    text = {i: r["_text"] for i, r in out.items()}
    assert [out[i]["n_mentions"] for i in range(6)] == [4, 5, 4, 5, 3, 0] and text[5] == TEXTS[5]

    a, b, c, d = re.findall(r"[\w.]+@[\w.]+\w", text[0])
    assert a == b.lower() and b.isupper() and c != a and "@" in d
    assert len(a) == len("anna.lee@mail7.example.com") and a.endswith(".com") and re.fullmatch(r"[a-z]{4}\.[a-z]{3}@[a-z]{4}\d\.[a-z]{7}\.com", a)
    assert re.sub(r"\w", "x", d) == "xxxx.x@x.xxx"

    one, two = re.findall(r"\+1.\(?\d{3}\)?.\d{3}-\d{4}", text[1])
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two) and one[2:5:2] == " 0"[:1] + one[4] and two[2] == "-"
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", text[1])
    assert ips[0].startswith("10.") and not ips[1].startswith("10.") and ips[-1] == "300.1.1.1" and "2.0.1," in text[1]
    assert all(int(x) < 256 for ip in ips[:2] for x in ip.split("."))

    cards = [re.sub(" ", "", x) for x in re.findall(r"\b\d{4}(?: ?\d{4}){3}\b", text[2])]
    assert cards[0] == cards[1] != cards[2] and luhn(cards[0]) and not luhn(cards[2])
    assert re.search(r"Card \d{4} \d{4} \d{4} \d{4} and \d{16} and \d{16}; SSN \d{3}-\d{2}-\d{4}\.", text[2])

    names = re.fullmatch(r"Mrs\. (\w+ \w+) met Mr (\w+) and Frau (\w+); г-н (\w+)\. Mrs\. (\w+ \w+) left\. Sir, no name\.", text[3])
    assert names and names[1] == names[5] and re.fullmatch("[А-Яа-яё]+", names[4]) and re.fullmatch("[A-Za-z ]+", names[1])
    for i, original in enumerate(TEXTS[:5]):
        for secret in ("anna", "017", "5711", "8.8.4.4", "4111", "078-05", "Stone", "Müller", "Иванов", "4785380592391139", "97.51.17.173", "a.b@c"):
            assert secret not in text[i] or secret not in original, (i, secret)


def test_distinct_entities_stay_distinct(spark):
    """A third of the address space of a private network: surrogates must collide and be settled."""
    texts = [" ".join(f"192.168.{a}.{b}" for b in range(0, 256, 3)) for a in range(0, 256, 3)]
    texts += ["Mr " + w for w in ("Abel", "Baker", "Cole", "Dean")]
    found = mentions(frame(spark, texts))
    book = dictionary(found, "k").collect()
    assert len(book) == len({(r["kind"], r["entity"]) for r in book}) == found.select("kind", "entity").distinct().count()
    assert len({r["surrogate"] for r in book}) == len(book)
    real = {r["entity"] for r in book}
    assert not {r["surrogate"] for r in book} & real and all(r["surrogate"].startswith("192.168.") for r in book if r["kind"] == "ip")


def test_keys_and_attempts_give_other_surrogates(spark):
    df = spark.createDataFrame([("email", "a.b@c.de"), ("ip", "9.9.9.9"), ("card", "4111111111111111"), ("name", "f:eva stone")], "kind string, entity string")
    make = lambda key, n: [r[0] for r in df.select(surrogate(key, F.col("kind"), F.col("entity"), F.lit(n))).collect()]
    assert make("a", 0) == make("a", 0)
    assert not set(make("a", 0)) & set(make("b", 0)) and not set(make("a", 0)) & set(make("a", 1))


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    out = pseudonymise(docs, "k")
    assert out.columns == docs.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))  # nothing personal in them
    some = docs.withColumn("text", F.concat_ws(" ", "text", F.lit("Mail a.b@c.de")))
    new = pseudonymise(some, "k").collect()
    assert len(new) == len(ODD) and all("a.b@c.de" not in r["text"] and "Mail " in r["text"] for r in new)
    assert len({re.findall(r"\S+@\S+", r["text"])[0] for r in new}) == 1
    assert pseudonymise(no_docs(spark), "k").count() == 0


def test_spaces_more_than_half_full(spark):
    """Of 65,536 and 676 values more than half are entities: no assignment exists inside the space."""
    texts = [" ".join(f"192.168.{a}.{b}" for b in range(256)) for a in range(140)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts += [" ".join(f"{a}@{b}.de" for b in letters) for a in letters]
    book = dictionary(mentions(frame(spark, texts)), "k").collect()
    assert len(book) == 140 * 256 + 26 * 26 == len({r["surrogate"] for r in book})
    assert not {r["surrogate"] for r in book} & {r["entity"] for r in book}
    assert all(re.match(r"192\.168\.|10\.", r["surrogate"]) for r in book if r["kind"] == "ip")
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.de", r["surrogate"]) for r in book if r["kind"] == "email")
