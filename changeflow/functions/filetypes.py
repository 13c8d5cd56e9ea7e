"""Flags read off a file type string."""

from pyspark.sql import Column

# The patterns that decide each flag. The faithful ones match the whole string.
KEYWORD_TYPE = {"faithful": r"\A(?:k|\+.*k)\z", "corrected": r"^k|\+.*k"}
EXECUTABLE_TYPE = {"faithful": r"\A(?:[cku]?x|\+.*x)\z", "corrected": r"^[cku]?x|\+.*x"}
TEXT_TYPES = ("text", "unicode")
SYMLINK_MARK = "symlink"


def expands_keywords(file_type: Column, semantics: str = "faithful") -> Column:
    return file_type.rlike(KEYWORD_TYPE[semantics])


def is_executable(file_type: Column, semantics: str = "faithful") -> Column:
    return file_type.rlike(EXECUTABLE_TYPE[semantics])


def is_text(file_type: Column) -> Column:
    return file_type.isin(*TEXT_TYPES)


def is_symlink(file_type: Column) -> Column:
    return file_type.contains(SYMLINK_MARK)
