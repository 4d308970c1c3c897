import random

from postmill.functions.summary import (
    PREFIXES,
    coerce_summary,
    is_lenient_summary,
    is_strict_summary,
)

GOOD = "\n".join(f"{p} x" for p in PREFIXES)
BARE = "\n".join(PREFIXES)


DRAFTS = [
    (GOOD, True, True),
    (f"\n  {GOOD}\n\n", True, True),
    (GOOD.replace("\n", "\n \t\n\n"), True, True),
    (GOOD.replace("\n", "\r\n"), True, True),
    (GOOD.replace("\n", "\u2028"), True, True),
    (BARE, True, False),
    (GOOD.lower(), False, True),
    (GOOD.replace("\n2)", "\n 2)"), False, True),
    (GOOD.replace("1) P", "7)P"), False, True),
    (GOOD.replace("1) ", "\u0663)\u00a0"), False, True),
    (GOOD.replace("1) ", "10) "), False, False),
    (GOOD + "\nextra", False, False),
    (GOOD.replace("3) Action needed: x\n", ""), False, False),
    ("\n".join(reversed(GOOD.split("\n"))), False, True),
    ("\n".join([GOOD.split("\n")[0]] * 5), False, True),
    (GOOD.replace("Purpose: x", "Purpose:\u00a0"), True, False),
    (GOOD.replace("Purpose: x", "Purpose:"), True, False),
    (GOOD.replace("Key", "\u212aey"), False, True),
    ("", False, False),
    (" \n ", False, False),
]


def test_validators(apply):
    texts, strict, lenient = zip(*DRAFTS, strict=True)
    assert apply(is_strict_summary, texts) == list(strict)
    assert apply(is_lenient_summary, texts) == list(lenient)


def test_coerce(apply):
    texts = [
        "", "only", GOOD + "\nsixth", "  1) Purpose: a  \n\n\t2) Key details:\r\nodd\n",
        "2) Key details: b\n1) Purpose: a",
    ]
    n_a = [f"{p} N/A" for p in PREFIXES]
    assert [t.split("\n") for t in apply(coerce_summary, texts)] == [
        n_a,
        ["1) Purpose: only", *n_a[1:]],
        GOOD.split("\n"),
        ["1) Purpose: a", "2) Key details:", "3) Action needed: odd", *n_a[3:]],
        ["1) Purpose: 2) Key details: b", "2) Key details: 1) Purpose: a", *n_a[2:]],
    ]


def test_coerced_is_always_valid(apply):
    rng = random.Random(3)
    pieces = [*PREFIXES, "x", " ", "\n", "\n\n", "\r", "\x1c", "\x1f", "\u2029", "1)", "\u3000", "N/A"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(1000)]
    coerced = apply(coerce_summary, texts)
    assert all(apply(is_strict_summary, coerced))
    for text, result in zip(texts, coerced, strict=True):
        lines = [line.strip() for line in text.splitlines() if line.strip()][:5]
        assert [len(r) for r in result.split("\n")][: len(lines)] == [
            len(line) if line.startswith(p) else len(p) + 1 + len(line)
            for line, p in zip(lines, PREFIXES, strict=False)
        ]


def test_many_blank_lines(apply):
    long = GOOD.replace("\n", "\n" + " \n" * 50_000)
    assert apply(is_strict_summary, [long]) == [True]
    assert apply(is_lenient_summary, [long]) == [True]
    assert apply(coerce_summary, [long]) == [GOOD]
