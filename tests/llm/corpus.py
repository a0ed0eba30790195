"""Small hand-made document tables for the operator tests."""
import random

WORDS = [f"{a}{b}" for a in ("sta", "Ren", "mo", "lé", "Über", "tik", "日本", "qua") for b in ("n", "rd", "lla", "x", "")]
CLASHES = ("id", "h", "n", "norm", "key", "chunk", "node", "bucket", "score", "text_hash", "kept")


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", ".\n", "  "]) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Null, empty, blank, one-word, repeated, mixed-case, very long and odd texts."""
    rnd = random.Random(4)
    base = prose(rnd, 60)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "two Words"), (5, "TWO words"), (6, "two words"),
            (7, base), (8, base.upper()), (9, base), (10, base + " tail end"), (11, "x" * 3000),
            (12, "a  b\r\n\r\nc \x1c d e 🙂🙂 'll don't <|endoftext|> 12345 ###"), (13, prose(rnd, 9000)),
            (14, None), (15, "a b a b a b a b " * 30), (16, "\n\n\nlead"), (17, "end \n")]
    rows += [(100 + i, prose(rnd, rnd.randint(1, 120))) for i in range(40)]
    return rows


def table(spark, rows):
    """doc_id, text and further columns whose names the operators use inside."""
    extra = "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *("clash",) * len(CLASHES)) for r in rows], f"doc_id long, text string{extra}")


def empty(spark):
    return table(spark, [])
