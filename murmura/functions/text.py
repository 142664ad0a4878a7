"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmura import constants as K


def normalize_text(text: Column) -> Column:
    """Lower case, accents folded, white space to single blanks, runs of '.' and '!' to one."""
    folded = F.translate(F.lower(text), K.ACCENTED, K.FOLDED)
    spaced = F.trim(F.regexp_replace(folded, K.UNEVEN_SPACE, " "))
    return F.regexp_replace(F.regexp_replace(spaced, r"[.][.]+", "."), r"!!+", "!")


def tokens(text: Column) -> Column:
    """Words between blanks; an empty text has none."""
    return F.array_remove(F.split(text, " "), "")


def word_set(text: Column) -> Column:
    """The words without repeats. Stays inside generated code, unlike a lambda filter."""
    return F.array_except(F.split(text, " "), F.array(F.lit("")))


def letters_only(text: Column) -> Column:
    """Normalised words stripped of punctuation, for lexicon look-ups."""
    return tokens(F.regexp_replace(normalize_text(text), r"[^\p{L}\p{N}/]+", " "))


def ascii_only(text: Column) -> Column:
    """Every character outside printable ASCII as '?', for engines that count bytes."""
    return F.regexp_replace(text, r"[^ -~]", "?")


def piece_pattern(hi: int = K.MAX_PAIN_CHARS) -> str:
    """The next piece of a long sentence: up to its last clause mark, else the last word end, within `hi`."""
    return rf"(?s)\S(?:.{{0,{hi - 3}}}[^\s,;:])?[,;:](?:\s|$)|\S(?:.{{0,{hi - 2}}}\S)?(?:\s|$)|\S{{1,{hi}}}"


def sentences(text: Column, lo: int = K.MIN_PAIN_CHARS, hi: int = K.MAX_PAIN_CHARS) -> Column:
    """A whole text as sentences of at most `hi` characters; every word is in one of them.

    Longer sentences are cut at clause marks, else at word ends (a word longer than `hi` inside).
    Pieces under `lo` join the piece before or after them if the bound allows.
    """
    parts = F.filter(F.transform(F.split(text, r"[.!?\n]+"), lambda s: F.trim(s)), lambda s: F.length(s) > 0)
    long = F.lit(piece_pattern(hi))
    cut = F.flatten(
        F.transform(
            parts,
            lambda s: F.when(F.length(s) <= hi, F.array(s)).otherwise(
                F.transform(F.regexp_extract_all(s, long, F.lit(0)), lambda x: F.trim(x))
            ),
        )
    )

    def step(acc: Column, piece: Column) -> Column:
        last, size = acc["last"], F.length(piece)
        joins = (last >= 0) & ((last < lo) | (size < lo)) & (last + 1 + size <= hi)
        return F.when(joins, state(F.concat(acc["marks"], F.lit(" ")), last + 1 + size)).otherwise(
            state(F.concat(acc["marks"], F.lit("\n")), size)
        )

    def state(marks: Column, last: Column) -> Column:
        return F.struct(marks.alias("marks"), last.alias("last"))

    def joined(pieces: Column) -> Column:
        # What stands before each piece: a blank, or a line end where a sentence begins. No piece holds a line end,
        # and a list of results that grew piece by piece would be copied for each.
        marks = F.aggregate(pieces, state(F.lit(""), F.lit(-1)), step, lambda acc: acc["marks"])
        text = F.array_join(F.zip_with(pieces, F.split(marks, ""), lambda piece, mark: F.concat(mark, piece)), "")
        return F.when(F.size(pieces) == 0, F.array().cast("array<string>")).otherwise(
            F.split(F.substring(text, F.lit(2), F.length(text)), "\n")
        )

    # The list of one computes the pieces once.
    return F.flatten(F.transform(F.array(cut), joined))


def generalize_text(text: Column) -> Column:
    """Drop amounts, percents, dates and numbers; collapse the blanks left behind."""
    out = F.regexp_replace(text, r"(?i)R\$ ?[0-9][0-9.,]*", " ")
    out = F.regexp_replace(out, r"[0-9]{1,4}[/-][0-9]{1,2}[/-][0-9]{1,4}", " ")
    out = F.regexp_replace(out, r"[0-9]+([.,][0-9]+)* ?%", " ")
    out = F.regexp_replace(out, r"[0-9]+([.,][0-9]+)*", " ")
    return F.trim(F.regexp_replace(out, K.WHITESPACE, " "))


def contains_any(text: Column, words) -> Column:
    """True if any of the given words occurs in the lower-cased text."""
    low = F.lower(text)
    return F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(low, w))


def preview(text: Column, size: int = 100) -> Column:
    return F.substring(text, 1, size)


def canonical_id(text: Column, categoria: Column, familia: Column) -> Column:
    """Readable id: category and family prefixes, then a text hash. No clock, so reruns agree."""
    digest = F.substring(F.md5(F.lower(text)), 1, 8)
    return F.lower(F.concat_ws("_", F.substring(categoria, 1, 4), F.substring(familia, 1, 4), digest))


def canonical_key(text: Column, categoria: Column, familia: Column) -> Column:
    """Id of a new canonical: as `canonical_id`, with the whole hash over text and context, as eight
    digits collide in a large store."""
    digest = F.md5(F.lower(F.concat_ws("\u001f", text, categoria, familia)))
    return F.lower(F.concat_ws("_", F.substring(categoria, 1, 4), F.substring(familia, 1, 4), digest))


def within_simple_limits(text: Column, max_chars: int = 200, max_words: int = 40) -> Column:
    """Gate of a simplified canonical text."""
    return (F.length(text) > 0) & (F.length(text) <= max_chars) & (F.size(tokens(text)) <= max_words)
