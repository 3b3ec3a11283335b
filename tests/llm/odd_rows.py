"""Small tables with everything that real ones may hold: nulls, empty and long texts, ties, repeated rows, odd columns."""

import random

from pyspark.sql import types as T

WORDS = "the of and to in is that for with was stone river cloud letter garden winter number silver morning paper".split()
INSULTS = ("idiot", "moron", "loser")


def prose(draw, words):
    out = []
    for _ in range(words):
        out.append(draw.choice(WORDS) + draw.choice(["", "", "", "s", "ed", ".", ",", ".\n"]))
    return " ".join(out)


def document_rows():
    draw = random.Random(4)
    rows = []
    for i in range(160):
        text = prose(draw, draw.randint(3, 120))
        toxic = i % 5 == 0
        if toxic:
            text += f" you {draw.choice(INSULTS)} and {draw.choice(INSULTS)}"
        if i % 7 == 0:
            text += f" mail a.b{i}@example{i % 3}.com or +1 (555) 555-{1000 + i} at 10.0.{i}.7"
        rows.append((i * 3, text, "en", f"src{0 if i % 3 else i % 10}", len(text)))
    rows += [(1000 + i, rows[8][1], "en", "src0", rows[8][4]) for i in range(12)]  # exact copies
    near = rows[11][1] + " " + prose(draw, 150)
    rows += [(1100 + i, f"{near} ending{i}", "de", "src1", 9) for i in range(8)]  # near copies
    rows += [(1200, None, "en", "src1", 0), (1201, "", "en", "src1", 0), (1202, " \n\t ", None, "src1", None)]
    rows += [(1203, "Ünïcode 漢字 \U0001f600 it's <|endoftext|> x", "fr", None, 5), (None, "no key here at all", "en", "src2", 18)]
    rows += [(1204, prose(draw, 30_000), "en", "src3", 1), (1205, "x" * 70_000 + " " + "7" * 9_000, "en", "src3", 1)]
    rows += [rows[20], rows[20], (rows[21][0], "another text of a known key", "en", "src4", 3)]  # repeated row, repeated key
    return rows


DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use for columns of their own.
CLASHING = ("key", "range", "node", "label", "size", "copy", "fingerprint", "sequence_id", "shard", "component_id", "_digest")


def page_rows():
    big, draw = "<p>" + "same page " * 40 + "</p>", random.Random(5)
    rows = [(i, f"http://a.example/{i} x", f"<html>{prose(draw, 60)}{i}</html>") for i in range(40)]
    rows += [(100 + i, "http://b.example/", big) for i in range(30)] + [(90, None, big), (91, "u\r\nv", "tiny"), (92, "u", "tiny")]
    rows += [(93, "u", None), (94, "u", ""), (None, "u", big), (95, "u", "é漢" * 30_000), (96, "u", "é漢" * 30_000)]
    return rows + [rows[3], rows[40]]


def vector_rows():
    draw = random.Random(6)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(8)], 0) for i in range(320)]
    rows += [(400 + i, rows[7][1], 0) for i in range(25)]  # ties
    rows += [(500, None, 0), (600, [1.0, None] + [0.0] * 6, 0), (700, [float("nan")] * 8, 0), (801, [float("inf")] * 8, 0)]
    rows += [(900, [0.5, 0.5, 0.5], 0), (901, [0.1, 0.2, 0.3], 0), (None, [0.0] * 8, 0), rows[5], (1000, [], 0), (1001, [], 0)]
    # Repeated keys, of queries and others, with equal and with different vectors.
    rows += [rows[200], (200, rows[9][1], 0), (77, rows[100][1], 0), (77, [0.9] * 8, 0), (77, [0.9] * 8, 0)]
    return rows
