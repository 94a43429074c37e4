import random

import pytest

from gridmart.llm import lines

SCHEMA = "doc_id long, text string, n_lines string, lang string"


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def plain(rows, least, edits):
    seen, out = [], {}
    for doc, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            if len(line) < least:
                kept.append(line)
                continue
            if not any(line == s or (edits and near(line, s)) for s in seen):
                kept.append(line)
            seen.append(line)
        out[doc] = "\n".join(kept)
    return out


@pytest.mark.parametrize("edits", [0, 1])
def test_equals_all_pairs(spark, edits):
    draw = random.Random(edits)
    bases = ["".join(draw.choices("abé ", k=n)) for n in (4, 5, 6, 7, 30, 31, 300, 600, 2100)]
    rows = []
    for doc in range(120):
        text = []
        for _ in range(draw.randint(0, 5)):
            line = list(draw.choice(bases))
            for _ in range(draw.choice([0, 1, 1, 2])):
                at = draw.randrange(len(line) + 1)
                line[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "é", "z"])
            text.append("".join(line))
        rows.append((doc, "\n".join(text)))
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = lines.dedup_lines(frame, min_chars=4, max_edits=edits)
    assert {r["doc_id"]: r["text"] for r in found.collect()} == plain(rows, 4, edits)


def test_rows_in_every_state(spark):
    same = "a line that is repeated"
    rows = [
        (None, same, "", ""),
        (1, f"{same}\n{same}\nshort\nshort", "", ""),
        (2, None, "", ""),
        (3, "", "", ""),
        (4, f"first place of it\r\n{same}!", "", ""),
        (5, "first place of it\r", "", ""),
        (5, "first place of it\r", "", ""),
        (6, "x" * 50_000 + "\n" + "x" * 49_999 + "y", "", ""),
    ]
    found = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["doc_id", "text", "lang", "n_lines", "n_removed"]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in found.collect()), key=str)
    expected = [
        (None, same, 1, 0),
        (1, "short\nshort", 4, 2),
        (2, None, 0, 0),
        (3, "", 1, 0),
        (4, "first place of it\r", 2, 1),
        (5, "", 1, 1),
        (5, "", 1, 1),
        (6, "x" * 50_000, 2, 1),
    ]
    assert got == sorted(expected, key=str)
    assert lines.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        lines.dedup_lines(spark.createDataFrame(rows, SCHEMA), max_edits=2)


def test_long_lines_equal_all_pairs(spark):
    """Lengths around whole blocks and around the length from which lines are read in chains."""
    draw = random.Random(8)
    rows = []
    for n in (4095, 4096, 4097, 4351, 4352, 5120, 5121, 9001):
        base = "".join(draw.choices("abé😀 ", k=n))
        for at in (0, 1, 255, 256, n // 2, n - 257, n - 256, n - 2, n - 1):
            change = draw.choice(["x", "", base[at] + "x", "xy"])
            rows.append((len(rows), base[:at] + change + base[at + 1 :]))
        rows.append((len(rows), base))
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = {r["doc_id"]: r["text"] for r in lines.dedup_lines(frame).collect()}
    assert found == plain(rows, 10, 1)
    assert 8 < sum(not t for t in found.values()) < len(rows)


def test_lines_of_a_megabyte(spark):
    draw = random.Random(9)
    line = "".join(draw.choices("abcdé ", k=1_000_000))
    near = [line[:700_000] + "#" + line[700_001:], line[:10] + line[11:], line + "x", "xy" + line]
    frame = spark.createDataFrame([(k, text, "x", "y") for k, text in enumerate([line, *near, line[::-1]])], SCHEMA)
    found = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(frame).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0, 5: 0}
