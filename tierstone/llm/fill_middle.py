"""Fill-in-the-middle training texts by one regular expression with counted quantifiers.

``regexp_count`` gives the number n of units of a text, its code points. Hashes of the
document's id draw two cut points a <= b; the row's own pattern
``\\A(unit{a}+)(unit{b-a}+)(.*+)\\z`` captures prefix, middle and suffix in one match,
and the replacement puts them behind their markers in the order of the form. All of it is
JVM-side; possessive quantifiers make the match linear and keep the regex engine from
recursing, so texts of any length are cut whole.

Defined cases
* A null text is an empty one. Empty texts and texts that hold a marker stay plain, as do
  those that the hash leaves out; lengths are then null.
* The draw depends on ``doc_id`` alone, so rows that repeat an id have the same draw; a null
  id draws as the empty string.
* Other columns stay as they are. Empty tables give empty tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import fresh_name

#: One code point.
UNIT = r"(?s:.)"
#: Markers of prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Hundredths of the texts that are cut, and of those the ones with the suffix first.
CUT, SUFFIX_FIRST = 90, 20
#: Units counted at a time, which bounds the number of matches that are held at once.
STRIDE = 512


def _checked(markers: tuple[str, str, str]) -> None:
    """No marker may begin inside another or inside itself: a text's end and a marker would
    then make one up, and the output could not be taken apart."""
    for one in markers:
        for two in markers:
            tails = [one[k:] for k in range(len(one)) if k or one is not two]
            if any(two.startswith(t) or t.startswith(two) for t in tails) or not one:
                raise ValueError(f"markers {one!r} and {two!r} overlap")


def unit_count(text: Column) -> Column:
    """The units of ``text``, counted ``STRIDE`` at a time and then singly."""
    whole = rf"{UNIT}{{{STRIDE}}}+"
    rest = F.regexp_replace(text, rf"(?s)\A(?:{whole})*+", F.lit(""))
    return (
        F.regexp_count(text, F.lit(whole)).cast("long") * STRIDE
        + F.regexp_count(rest, F.lit(UNIT))
    )


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    into: str = "fim",
    seed: int = 1,
    markers: tuple[str, str, str] = MARKERS,
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``docs`` with a struct column: n, form, prefix and middle lengths, output.

    The form is ``psm``, ``spm`` or ``plain``.
    """
    _checked(markers)
    text, state = fresh_name(docs, "fim_text"), fresh_name(docs, "fim_draw")
    own = F.col(text)
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    marked = F.lit(False)
    for marker in markers:
        marked = marked | F.contains(own, F.lit(marker))
    counted = docs.select(
        "*", F.coalesce(F.col("text"), F.lit("")).alias(text)
    ).select("*", F.struct(unit_count(own).alias("n"), h1.alias("h1"), h2.alias("h2"),
                           h3.alias("h3"), h4.alias("h4"), marked.alias("marked")).alias(state))
    n = F.col(state)["n"]
    one, two = F.col(state)["h1"] % (n + 1), F.col(state)["h2"] % (n + 1)
    form = (
        F.when((n == 0) | F.col(state)["marked"] | (F.col(state)["h3"] % 100 >= cut), "plain")
        .when(F.col(state)["h4"] % 100 < suffix_first, "spm")
        .otherwise("psm")
    )
    drawn = counted.withColumn(
        state,
        F.struct(
            n.alias("n"),
            form.alias("form"),
            F.least(one, two).alias("a"),
            F.abs(one - two).alias("gap"),
        ),
    )
    a, gap, form = (F.col(state)[name] for name in ("a", "gap", "form"))
    pattern = F.format_string(rf"(?s)\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)(.*+)\z", a, gap)
    prefix, suffix, middle = (re.sub(r"([\\$])", r"\\\1", m) for m in markers)
    order = F.when(
        form == "spm", F.lit(f"{suffix}$3{prefix}$1{middle}$2")
    ).otherwise(F.lit(f"{prefix}$1{suffix}$3{middle}$2"))
    plain = form == "plain"
    result = F.struct(
        F.col(state)["n"].alias("n"),
        form.alias("form"),
        F.when(~plain, a).alias("prefix_chars"),
        F.when(~plain, gap).alias("middle_chars"),
        F.when(plain, own).otherwise(F.regexp_replace(own, pattern, order)).alias("output"),
    )
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(into))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made from. No marker stands inside a cut text, so the first
    one of its kind is the one that was put there."""
    prefix, suffix, middle = (r"\Q" + m.replace(r"\E", r"\E\\E\Q") + r"\E" for m in markers)
    psm = rf"(?s)\A{prefix}(.*?){suffix}(.*?){middle}(.*+)\z"
    spm = rf"(?s)\A{suffix}(.*?){prefix}(.*?){middle}(.*+)\z"
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, spm, "$2$3$1"))
        .otherwise(output)
    )
