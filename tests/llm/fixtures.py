"""Small tables that hold what the operators must stand: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with names that the operators use for themselves.
CLASH = ("size long, target double, fp long, h long, k1 long, rank int, at string, line string, _row string, _h long, gone string, "
         "score double, term string, u long, v long, node string, component string, key long, word string, n int, piece_ids string")


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi",
         "omicron", "pi", "rho", "sigma", "tau", "upsilon", "phi", "chi", "psi", "omega", "Éclair", "naïve", "straße", "日本"]


def texts(seed=0, n=40):
    """Random texts with copies, near copies, shared lines, blanks, nulls and a long one."""
    rng = random.Random(seed)
    out = ["\n".join(sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    words = out[3].split(" ")
    near = words[:]
    near[len(near) // 2] = "changed"
    out += [out[3], out[3], " ".join(near), out[5] + "\n" + out[6], "", None, "   \n\t", "one", "Two  words\n", "x" * 3000,
            sentence(rng, 5000), out[7].upper()]
    return out


def docs(spark, values=None, clash=False, seed=0):
    values = texts(seed) if values is None else values
    rows = [(i, t, "en", [None, "src0", "src0", "src1", "src2"][i % 5], None if t is None else len(t)) for i, t in enumerate(values)]
    df = spark.createDataFrame(rows, DOCS)
    return with_clash(spark, df) if clash else df


def with_clash(spark, df):
    from pyspark.sql import functions as F
    extra = [c.strip().split(" ") for c in CLASH.split(",")]
    kinds = {"long": "bigint"}
    return df.select("*", *[F.lit("7" if t == "string" else 7).cast(kinds.get(t, t)).alias(n) for n, t in extra if n not in df.columns])


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)
