"""Texts cut at their headings, then into passages that a citation can name.

A chapter begins with its heading line and ends before the next one. All of it happens within
a row: a text is split at places before headings, and each chapter into passages, so nothing
is shuffled, and a passage never holds the end of one chapter and the start of another.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 1000
#: What a heading line holds: a Markdown heading, a numbered part, or the name of a usual part.
HEADING = (
    r"#{1,6}[ \t]+[^\n]{1,200}"
    r"|(?iu:chapter|chapitre|kapitel|capítulo|part|partie|teil|parte|book|section|appendix)[ \t]+"
    r"(?:\d{1,4}|[IVXLCDM]{1,8})(?:[ \t]*[.:–—-][^\n]{0,100})?"
    r"|(?iu:prologue|epilogue|preface|foreword|introduction|afterword|conclusion)"
)
_END = r"[ \t\r]*(?:\n|\z)"


def chapter_chunks(texts: DataFrame, text: str = "text", heading: str = HEADING) -> DataFrame:
    """The columns of ``texts`` but for the text, with chapter_no, chapter, chunk_no, location, chunk.

    ``heading`` is a regular expression of a whole line but for white space at its end. chapter_no counts from 0;
    ``chapter`` is the heading without white space and ``#`` around it, NULL for what stands before the first one.
    chunk_no and location (the first character's offset) count within the chapter. Joined by chapter_no
    and chunk_no, the chunks are the whole text. Null and empty texts have none; repeated rows each
    have their own.
    """
    others = [F.col(f"`{c}`") for c in texts.columns if c != text]
    sections = F.split(F.col(text), rf"(?<![^\n])(?=(?:{heading}){_END})")
    title = F.btrim(F.regexp_extract("section", rf"\A(?:{heading})(?={_END})", 0), F.lit("# \t\r"))
    parts = F.regexp_extract_all("section", F.lit(f"(?s).{{1,{CHUNK_CHARS}}}"), F.lit(0))
    held = texts.select(F.struct(*others).alias("row"), F.posexplode(sections).alias("chapter_no", "section"))
    # the title is taken before passages multiply the rows
    held = held.withColumn("chapter", F.nullif(title, F.lit("")))
    found = held.select("row", "chapter_no", "chapter", F.posexplode(parts).alias("chunk_no", "chunk"))
    return found.selectExpr(
        "row.*", "chapter_no", "chapter", "chunk_no", f"chunk_no * {CHUNK_CHARS}L AS location", "chunk"
    )
