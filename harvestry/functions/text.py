"""Text and number cleaning as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode text stripping and splitting treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a pattern: character classes match several times faster than the list.
_SPACE_RUN = r"[\s\x1c-\x1f\x85\p{Z}]+"

# Fixed value: what counts as a number in scraped text.
NUMBER_PATTERN = "[,.0-9]+"

# A run of cased letters, or a run of anything else.
_CASE_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others.

    ``initcap`` would only restart after a blank: "it's two-bed" becomes "It'S Two-Bed"
    here. A first letter whose upper case is longer than one character stays as it is.
    """
    def recase(run: Column) -> Column:
        first = F.substring(run, 1, 1)
        upper = F.upper(first)
        # The digraphs that have a title form of their own.
        upper = F.translate(upper, "ǄǇǊǱ", "ǅǈǋǲ")
        head = F.when(F.length(upper) > 1, first).otherwise(upper)
        return F.concat(head, F.lower(F.substring(run, 2, 2**31 - 1)))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_CASE_RUNS), 1), recase), "")


def words(text: Column) -> Column:
    """Split on white space; blank text has no words."""
    return F.filter(F.split(text, _SPACE_RUN), lambda word: word != "")


def distinct_words(text: Column) -> Column:
    """Lower-cased words, distinct *before* lower-casing: "Split split" yields two."""
    return F.transform(F.array_distinct(words(text)), F.lower)


def number_texts(nodes: Column) -> Column:
    """All number-like matches of all text nodes, in order, without thousands commas."""
    found = F.flatten(F.transform(
        nodes, lambda node: F.regexp_extract_all(node, F.lit(NUMBER_PATTERN), 0)))
    return F.transform(found, lambda text: F.replace(text, F.lit(","), F.lit("")))


def numbers(nodes: Column, strict: bool = False) -> Column:
    """Numbers in text nodes; unparsable matches (".") are NULL, or an error if strict."""
    return F.transform(
        number_texts(nodes),
        lambda text: text.cast("double") if strict else text.try_cast("double"))


def each(nodes: Column, *processors) -> Column:
    """Apply Column functions to every element, left to right, dropping NULL results."""
    for process in processors:
        nodes = F.filter(F.transform(nodes, process), lambda value: value.isNotNull())
    return nodes


def none_if_empty(values: Column) -> Column:
    """An item field without values is absent."""
    return F.when(F.size(values) > 0, values)


def iso_text(moment: Column) -> Column:
    """ISO 8601 text; the fraction appears only where there are microseconds."""
    text = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")


def fits(text: Column, length: int) -> Column:
    """The first ``length`` characters."""
    return F.substring(text, 1, length)


def one_line(text: Column) -> Column:
    """Windows line ends become blanks; a lone line feed stays."""
    return F.replace(text, F.lit("\r\n"), F.lit(" "))
