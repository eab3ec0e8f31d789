"""The few exceptions user code may want to catch."""


class TidemarkError(Exception):
    """Base class."""


class InvalidArgument(TidemarkError, ValueError):
    """An option or parameter is wrong or contradicts another one."""


class AliasNotFound(TidemarkError, KeyError):
    """A table, entry or tag does not exist."""


class AliasAlreadyExists(TidemarkError):
    """A table with that name exists already."""


class IncompatibleTypes(TidemarkError, TypeError):
    """One or more columns do not fit the table; lists all of them."""

    def __init__(self, problems):
        self.problems = list(problems)
        super().__init__("\n".join(self.problems))


class CommitConflict(TidemarkError):
    """Another writer committed the same version first."""


class DamagedCommit(TidemarkError):
    """A published commit cannot be read; nothing may be skipped over it."""
