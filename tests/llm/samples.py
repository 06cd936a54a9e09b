"""Small tables with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(["ka", "lo", "mi", "tu", "re", "so"]) + r.choice(["n", "s", "ra", "del", "m"]) for _ in range(n)]
    return "".join(w + ("\n" if i % 9 == 8 else " ") for i, w in enumerate(words)).strip()


def rows() -> list[tuple]:
    shared = prose(900, 60)
    out = [(i, prose(i, 40 + 7 * i), "en", f"src{i % 5}", 1) for i in range(30)]
    out += [(100 + i, out[3][1], "en", "src0", 1) for i in range(12)]  # copies, all of one source
    out += [(200 + i, f"{prose(300 + i, 20)}\n{shared}\n{prose(400 + i, 15)}", "de", "src1", 1) for i in range(4)]
    near = out[20][1].split(" ")
    out.append((300, " ".join([*near[:50], "other", *near[51:]]), "en", "src2", 1))
    out += [
        (400, None, "en", "src0", None),
        (401, "", None, None, 0),
        (402, " \n\t ", "en", "src0", 3),
        (None, prose(5, 75), "en", "src0", 1),
        (None, None, None, None, None),
        (403, "Ab cd", "en", "src3", 1),
        (404, "ab CD", "en", "src3", 1),
        (405, "x" * 5000, "en", "src3", 1),
        (406, prose(77, 30000), "fr", "src4", 1),
        (407, "été ñandú 漢字 🙂  a b　c\r\nd, e. .f <|endoftext|>", "fr", "src4", 1),
    ]
    return out + [out[0], out[0]]  # repeated rows


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def words(text) -> list[bytes]:
    return (text or "").encode().split()
