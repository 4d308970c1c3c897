"""Whitespace, line and cleaning rules on edge values."""

import random
import sys

from postmill.functions import cleaning, pytext

ODD = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000\u200b\u180e\ufeff"


def random_texts(count, alphabet, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(count)]


def test_whitespace_is_pythons():
    assert pytext.WS_CHARS == "".join(
        chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()
    )


def test_strip_and_collapse(apply):
    texts = [*random_texts(500, "ab" + ODD), "", " ", ODD]
    assert apply(pytext.strip, texts) == [t.strip() for t in texts]
    assert apply(pytext.collapse_whitespace, texts) == [" ".join(t.split()) for t in texts]


def test_split_lines(apply):
    fixed = [
        "", "a", "a\n", "a\n\nb\n\n", "a\r\nb\rc", "\n", "\n\na",
        "x\x85y\u2028z\u2029", "a\x0bb\x0cc\x1cd\x1fe",
    ]
    texts = fixed + random_texts(500, "ab" + ODD)
    assert apply(pytext.split_lines, texts) == [t.splitlines() for t in texts]


QUOTED_HISTORY = [
    ("hello\nOn Mon, Bob wrote:\n> x", "hello"),
    ("hello\n  on mon WROTE: \t\nx", "hello"),
    ("hello\nOn Monday we wrote: a lot", "hello\nOn Monday we wrote: a lot"),
    ("On wrote:\nx", ""),
    ("a\nFrom: x@y\nb", "a"),
    ("a\nFrom:\nb", "a\nFrom:\nb"),
    ("a\nFrom:   \nb", "a\nFrom:   \nb"),
    ("a\n\u3000SENT:\u00a0now\nb", "a"),
    ("a\n\u017fubject: long s\nb", "a"),
    ("Subject: x\nbody", ""),
    ("a\nSubject:x\nb", "a\nSubject:x\nb"),
    ("a\n original message \nb", "a"),
    ("a\n-----Original Message-----\nb", "a\n-----Original Message-----\nb"),
    ("a\r\nb\x0bFrom: x\x0cc", "a\nb"),
    ("a\x85From: x", "a"),
    ("a\nxFrom: y", "a\nxFrom: y"),
    ("  a\r\nb  ", "a\nb"),
    ("", ""),
]


def test_quoted_history(apply):
    texts, expected = zip(*QUOTED_HISTORY, strict=True)
    assert apply(cleaning.strip_quoted_history, texts) == list(expected)


SIGNATURE = [
    ("hello\nThanks,\nAnn", "hello"),
    ("hello\n--\nAnn\nBest\nx", "hello\n--\nAnn"),
    ("Thanks for the note\nbody", ""),
    ("hello\nthanks", "hello\nthanks"),
    ("hello\n\t Bestseller list\nx", "hello"),
    ("hello\r\nSincerely", "hello"),
    ("a\u2028Regards", "a"),
    ("no marker\n here ", "no marker\n here"),
    ("in line Thanks", "in line Thanks"),
    ("a\n\n-- \nb", "a"),
    ("", ""),
    (" \n ", ""),
]


def test_signature(apply):
    texts, expected = zip(*SIGNATURE, strict=True)
    assert apply(cleaning.remove_signature, texts) == list(expected)


URLS = [
    ("see http://a.com/x), and HTTPS://B.org. http://a.com/x ok",
     ["HTTPS://B.org", "http://a.com/x"]),
    ("http://", []),
    ("http:// x", []),
    ("http://. x", ["http://"]),
    ("none", []),
    ("(http://q.com/a_(b)).", ["http://q.com/a_(b"]),
    ("http://x.y\u00a0z", ["http://x.y"]),
    ("http://a.,)b", ["http://a.,)b"]),
    ("http://.http://x", ["http://.http://x"]),
    ("http\u017f://a http\u1e9e://b", ["http\u017f://a"]),
    ("xhttp://a.b\x1fhttps://c", ["http://a.b", "https://c"]),
]


def test_urls(apply):
    texts, expected = zip(*URLS, strict=True)
    assert apply(cleaning.extract_urls, texts) == list(expected)


def test_truncate(apply):
    texts = [
        "x" * 4001, "a " * 2500, "ab " + "c" * 4000, "\u00e9" * 3999 + " b c",
        "\U0001f600" * 4001, "a" * 4000, "a" * 3999 + " b", " " + "x" * 4000,
    ]
    out = apply(cleaning.truncate_thread, texts)
    assert [len(o) for o in out] == [4004, 4003, 6, 4003, 4004, 4000, 4003, 4]
    assert out[5] == texts[5]
    for text, cut in zip(texts, out, strict=True):
        expected = text if len(text) <= 4000 else text[:4000].rpartition(" ")[0] or text[:4000]
        if " " in text[:4000] and len(text) > 4000:
            expected = text[: text[:4000].rindex(" ")]
        assert cut == expected + (" ..." if len(text) > 4000 else "")


def test_long_runs_stay_linear(apply):
    """Runs of blanks, breaks and slashes as long as a book must not take quadratic time."""
    texts = [" " * 300_000 + "x", "\n" * 300_000 + "x", "a" + " \n" * 200_000 + "b", "On " * 100_000]
    expected = ["x", "x", "a b", texts[3].strip()]
    cleaned = lambda x: cleaning.normalize_whitespace(cleaning.visible_text(x))
    assert apply(cleaned, texts) == expected
    assert apply(cleaning.remove_signature, texts)[:2] == ["x", "x"]
    assert apply(cleaning.strip_quoted_history, texts)[:2] == ["x", "x"]


def test_visible_text_is_the_two_cuts(apply):
    """On texts put together from markers and all kinds of breaks and blanks."""
    pieces = [
        "On x", "wrote:", "From:", "sent: ", "Subject:\u00a0", "Original Message", "--", "Thanks",
        "Best", "a", "b c", " ", "\t", "\u2003", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c",
        "\x1e", "\x1f", "\x85", "\u2028", "\u2029", "\n\n",
    ]
    texts = random_texts(3000, pieces)
    both = apply(lambda x: cleaning.remove_signature(cleaning.strip_quoted_history(x)), texts)
    assert [t.split() for t in apply(cleaning.visible_text, texts)] == [t.split() for t in both]


def test_clean_emails(spark):
    from postmill.operators.cleaning import clean_emails

    rows = [
        ("Hi", "see http://a.b/c, ok\n\nThanks\nhttp://sig"),
        ("", "plain   text"),
        (None, None),
        ("S", "Subject: again\nx"),
        ("L", "w " * 3000 + "http://late.example"),
    ]
    out = clean_emails(spark.createDataFrame(rows, "subject string, body string")).collect()
    assert out[0].clean_text == "Subject: Hi\nsee http://a.b/c, ok"
    assert out[0].urls == ["http://a.b/c"]
    assert out[1].clean_text == "plain text"
    assert (out[2].clean_text, out[2].urls) == ("", [])
    assert out[3].clean_text == "Subject: S\n"
    assert out[4].clean_text.endswith("w ...") and out[4].urls == ["http://late.example"]
    assert len(out[4].clean_text) <= len("Subject: L\n") + 4004


def test_cleaner_is_row_local(spark):
    """No exchange, no Python: the cleaner is projections over the scan."""
    from postmill.operators.cleaning import clean_emails

    mails = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = clean_emails(mails, subject="source", body="text").select("clean_text", "urls")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
    assert "ReadSchema: struct<text:string,source:string>" in text


def test_cleaning_keeps_columns_of_any_name(spark):
    from postmill.operators.cleaning import clean_emails

    rows = spark.createDataFrame([("s", "b", 1, "v", "f")], "subject string, body string, visible_text int, Flat_Text string, __flat string")
    row = clean_emails(rows).first()
    assert (row.visible_text, row.Flat_Text, row["__flat"], row.clean_text) == (1, "v", "f", "Subject: s\nb")
