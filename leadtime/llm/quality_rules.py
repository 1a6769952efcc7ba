"""Weak supervision: rules vote or abstain, EM weighs them, and a posterior decides.

Each rule says good (1), bad (-1) or nothing (0) about a document. Expectation-
maximisation over the counts of vote patterns estimates, for either class, how often a rule votes each
way; the posterior probability of "good" follows from the votes. At most
3 ** (number of rules) patterns exist, whatever the corpus holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadtime.llm.common import cut_lineage, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: Frequent words of the languages of the corpus, one of which running text can hardly do without.
COMMON = ("the", "of", "and", "to", "in", "is", "that", "de", "la", "le", "les", "et", "des", "que", "en", "el", "los",
          "der", "die", "und", "das", "von", "zu", "mit")


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and what else the rules look at.

    All is worked out inside the row, without a shuffle. ``n_repeat_words`` counts the words lying in
    a window of three words that the text holds twice or more; windows are told apart by a 64-bit hash.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    held = docs.withColumns({"_t": t, "_w": words(F.col(text))})
    held = held.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.translate("_t", BLANKS, "")).cast("long"),
        "n_symbols": (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"),
        "_lines": F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0),
        "_tri": F.expr("if(size(_w) < 3, cast(array() as array<bigint>), "
                       "transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])))"),
        "n_marks": F.length(F.regexp_replace("_t", "[^!?]+", "")).cast("long"),
        "n_upper": F.size(F.filter("_w", lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) > 1))).cast("long"),
        "n_common": F.size(F.filter("_w", lambda x: F.lower(x).isin(*COMMON))).cast("long"),
    })
    repeated = F.expr("""
        if(size(_tri) = size(array_distinct(_tri)), 0L, transform(
            array(array_sort(transform(_tri, (h, i) -> named_struct('h', h, 'i', i)))),
            s -> aggregate(
                array_sort(transform(filter(s, (p, j) -> coalesce(p.h = get(s, j - 1).h, false) or coalesce(p.h = get(s, j + 1).h, false)), p -> p.i)),
                named_struct('n', 0L, 'last', -3),
                (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i)).n)[0])""")
    out = held.withColumns({
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated,
    })
    return out.drop("_t", "_w", "_lines", "_tri")


def base_failed() -> Column:
    """The hard minimum: 50 words, and half of them outside repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _share(part: str, of: str = "n_words") -> Column:
    return F.col(part) / F.greatest(F.col(of), F.lit(1))


def rules() -> dict[str, Column]:
    """The votes, by name. A text without words gets a bad vote from the length rule and no good one."""
    some = F.col("n_words") > 0
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    return {
        "length": _vote(F.col("n_words") < 10, F.col("n_words") >= 50),
        "repetition": _vote(_share("n_repeat_words") > 0.3, some & (_share("n_repeat_words") < 0.15)),
        "lines": _vote(_share("n_dup_lines", "n_lines") > 0.3, (F.col("n_lines") > 2) & (F.col("n_dup_lines") == 0)),
        "symbols": _vote(_share("n_symbols") > 0.15, some & (_share("n_symbols") < 0.02)),
        "word_length": _vote(some & ((mean < 3) | (mean > 9)), some & (mean >= 4) & (mean <= 6.5)),
        "capitals": _vote(_share("n_upper") > 0.3, some & (_share("n_upper") < 0.05)),
        "marks": _vote(_share("n_marks") > 0.5, some & (_share("n_marks") < 0.1)),
        "common_words": _vote((F.col("n_words") >= 30) & (_share("n_common") < 0.02), _share("n_common") >= 0.06),
    }


def fit_votes(patterns: Sequence[tuple[Sequence[int], int]], rounds: int = 50, smooth: float = 1.0) -> dict:
    """EM over (votes, count) pairs: the share of good documents and, per rule, P(vote | class).

    Starts from the belief that one bad vote makes a document suspect, which also fixes which class is "good".
    """
    if not patterns:
        return {"prior": 0.5, "votes": []}
    n_rules = len(patterns[0][0])
    belief = [0.95 if min(v) >= 0 and max(v) > 0 else 0.1 for v, _ in patterns]
    total = sum(n for _, n in patterns)
    prior, tables = 0.5, []
    for _ in range(rounds):
        good = sum(b * n for b, (_, n) in zip(belief, patterns))
        prior = (good + smooth) / (total + 2 * smooth)
        tables = []
        for j in range(n_rules):
            table = {}
            for cls in (0, 1):
                mass = {v: smooth for v in (-1, 0, 1)}
                for b, (votes, n) in zip(belief, patterns):
                    mass[votes[j]] += n * (b if cls else 1 - b)
                whole = sum(mass.values())
                table[cls] = {v: m / whole for v, m in mass.items()}
            tables.append(table)
        belief = [1 / (1 + math.exp(-max(-500.0, min(500.0, _log_odds(v, prior, tables))))) for v, _ in patterns]
    return {"prior": prior, "votes": tables}


def _log_odds(votes: Sequence[int], prior: float, tables: list) -> float:
    return math.log(prior / (1 - prior)) + sum(math.log(t[1][v] / t[0][v]) for v, t in zip(votes, tables))


def posterior(model: dict, votes: dict[str, Column]) -> Column:
    """P(good | votes) as a column expression."""
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for table, vote in zip(model["votes"], votes.values()):
        weight = {v: math.log(table[1][v] / table[0][v]) for v in (-1, 0, 1)}
        odds = odds + F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0])
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """One row per document: key, base counts, base_failed, quality (posterior), kept, and the columns named in ``keep``.

    Rows are judged one by one, so repeated rows give repeated results. NULL and empty texts fail the base rule.
    """
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["n_lines", "n_marks", "n_upper", "n_common"]
    counted = base_columns(docs.select(key, F.col(text).alias("_text"), *[c for c in keep if c not in (key, text)]), "_text")
    counted = cut_lineage(counted.drop("_text") if text not in keep else counted.withColumnRenamed("_text", text), "quality-counts")
    votes = rules()
    seen = counted.groupBy(*[v.alias(n) for n, v in votes.items()]).count().collect()  # 3 ** 8 rows at most
    model = fit_votes([(tuple(r[n] for n in votes), r["count"]) for r in sorted(seen)])
    if not model["votes"]:
        quality = F.lit(0.5)
    else:
        quality = posterior(model, votes)
    judged = counted.withColumns({"base_failed": base_failed(), "quality": quality})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).drop(*more)
