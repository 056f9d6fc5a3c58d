"""Errors raised by the library. All derive from ``SlotmillError``."""


class SlotmillError(Exception):
    """Base class."""


class MissingInput(SlotmillError):
    """The newest day folder holds no matching drop file."""


class NoDayFolder(SlotmillError):
    """No folder under the landing root carries the wanted year prefix."""


class EmptyLoad(SlotmillError):
    """A file or frame has no rows where some are demanded; nothing was replaced."""


class DuplicateFileId(SlotmillError):
    """Two files of different names, or two copies of one, meet under one file id."""


class FileClaimed(SlotmillError):
    """Another load of the same import date and file id is under way."""


class CountMismatch(SlotmillError):
    """Parsed rows and non-blank lines of a file disagree."""


class BadRequirement(SlotmillError):
    """A prerequisite lacks a field or allows an unknown status."""


class UnknownLogId(SlotmillError):
    """An update names a log row that does not exist."""


class BadCells(SlotmillError):
    """A report was written with its faults listed beside it."""
