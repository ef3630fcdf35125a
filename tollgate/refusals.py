"""Everything the library refuses to do; a check that evaluated nothing refuses, it never passes."""


class Refusal(Exception):
    """The base of all refusals."""


class ContractError(Refusal):
    """A contract that can't be judged by."""


class NothingChecked(Refusal):
    """Rows were there, and no rule was evaluated on any."""


class ReasonColumnClash(Refusal):
    """The data have a column named as the reasons' column."""


class NoQuarantine(Refusal):
    """No split to read, or none with rows."""


class CannotRelax(Refusal):
    """A rule that isn't there, or whose removal leaves no contract."""


class HeaderMismatch(Refusal):
    """The columns aren't the contract's, in its order."""


class UnjudgedPartition(Refusal):
    """No verdict beside the accepted rows."""


class WrongPartition(Refusal):
    """The verdict is of another partition."""


class LoadCountMismatch(Refusal):
    """The number of rows isn't what the verdict says."""


class ContentMismatch(Refusal):
    """The staged rows aren't the source's rows."""


class MetadataColumnClash(Refusal):
    """A contract column is named as a column the raw layer adds."""


class UnknownDialect(Refusal):
    """No statements for this dialect."""


class MissingPartitions(Refusal):
    """A range with days that weren't judged."""


class BackfillStopped(Refusal):
    """A partition failed; ``completed`` has those before it."""

    def __init__(self, partition: str, completed: list[str], cause: Exception):
        super().__init__(f"stopped at {partition} after {len(completed)} partitions: {cause}")
        self.partition, self.completed, self.cause = partition, completed, cause


class NoHistory(Refusal):
    """A history without versions."""


class IncompletePartition(Refusal):
    """Fewer or more rows came than the source counts."""


class CommitConflict(Refusal):
    """Another run wrote the version that this one was to be."""
