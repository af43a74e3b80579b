from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from terrace.llm.secret_scan import CREDENTIAL, RUN, scan

from .helpers import ODD, no_docs, odd_docs


def secret(i: int) -> str:
    return hashlib.sha1(str(i).encode()).hexdigest()


def corpus(n=240):
    rng = random.Random(1)
    word = lambda: rng.choice(["the", "server", "reads", "values", "from", "logs", "every", "night"])
    rows, truth = [], {}
    for i in range(n):
        w = [word() for _ in range(30)]
        at = rng.randrange(3, 27)
        match i % 4:
            case 0:
                value = secret(i)
                w[at : at + 1] = ["token", "=", f'"{value}"']
            case 1:
                value = "".join(rng.choice("0123456789") for _ in range(16))
                w[at] = value
            case 2:
                value = f"reads-values-logs-{i}-night"
                w[at] = value
            case _:
                value = secret(i)
                w[at : at + 1] = ["commit", value]
        truth[i] = (value, i % 4 == 0)
        rows.append((i, " ".join(w), "docs/a" if i % 3 else None))
    return rows, truth


def test_findings_and_verdicts(spark):
    rows, truth = corpus()
    got = scan(spark.createDataFrame(rows, "doc_id long, text string, path string"), path=F.col("path")).collect()
    assert {r["doc_id"]: r["value"] for r in got} == {i: v for i, (v, _) in truth.items()}
    wrong = [r for r in got if r["is_secret"] != truth[r["doc_id"]][1]]
    assert len(wrong) <= 4
    for r in got:
        assert 0 <= r["probability"] <= 1 and r["length"] == len(r["value"])


def test_forest_learns_from_given_labels(spark):
    """Labels that no rule would give: here hexadecimal values are harmless, digits are not."""
    rows, truth = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    judged = [(v, float(v.isdigit())) for i, (v, _) in truth.items() if i < 120]
    got = scan(docs, path=F.col("path"), labelled=spark.createDataFrame(judged, "value string, label double")).collect()
    rest = [r for r in got if r["doc_id"] >= 120]
    assert sum(r["is_secret"] != r["value"].isdigit() for r in rest) <= 2


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    assert scan(docs).collect() == []
    long = "x " * 20_000 + 'api_key: "' + secret(1) + '" and ' + secret(2) + "," + secret(3)
    some = spark.createDataFrame([(1, long), (None, long), (2, None), (3, secret(4) + "\n")], "doc_id long, text string").withColumn("value", F.lit("v"))
    got = scan(some).collect()
    assert len(got) == 7 and {r["part"] for r in got} == {0, 1} and all(r["probability"] in (0.0, 0.5, 1.0) or 0 <= r["probability"] <= 1 for r in got)
    assert scan(no_docs(spark)).count() == 0
    assert len(ODD) and RUN and CREDENTIAL


def test_short_and_punctuated_values_are_candidates(spark):
    texts = {
        1: ('so password = "Winter2024!" is set', ["Winter2024!"]), 2: ("pwd='s3cr3t-pw'", ["s3cr3t-pw"]),
        3: ('the secret: "P@ss.w0rd#2024!long" here', ["P@ss.w0rd#2024!long"]), 4: ("passwd: hunter2, then", ["hunter2"]),
        5: ('{"password":"a1b!","api_key":"k:9/x","n":1}', ["a1b!", "k:9/x"]), 6: ('PASSWORD = "correct horse 7 battery"', ["correct horse 7 battery"]),
        7: ("DB_PASSWORD_PROD=q#7z;x", ["q#7z"]), 8: ("the author: Smith, and no password = here, pwd=abc", ["here"]), 9: ('token="' + secret(1) + '"', [secret(1)]),
        10: ("api_key=" + secret(2) + ".tail!", [secret(2) + ".tail!"]), 11: ('password: "" and secret = "', []), 12: ("a\x01b password=x\x02y9z", ["x.y9z"]),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    got = {i: [] for i in texts}
    for r in sorted(scan(docs).collect(), key=lambda r: (r["doc_id"], r["place"], r["part"])):
        got[r["doc_id"]].append(r["value"])
        assert r["place"] is not None and r["length"] == len(r["value"]) and 0 <= r["probability"] <= 1
    assert got == {i: v for i, (_, v) in texts.items()}


def test_long_quoted_values_are_whole(spark):
    values = ["k9!" + "x" * 800, " ".join(f"w{i}" for i in range(900)), "a1 \t b2"]
    text = " and ".join(f'password = "{v}"' for v in values)
    got = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [r["value"] for r in sorted(got, key=lambda r: r["place"])] == [" ".join(v.split()) for v in values]
