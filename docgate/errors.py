"""Errors that stop a job."""


class IngestError(RuntimeError):
    """A source cannot be read as asked."""


class GateRejected(RuntimeError):
    """A batch failed the quality gate."""


class LoadError(RuntimeError):
    """Rows cannot be written as asked."""
