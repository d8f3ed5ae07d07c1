"""Errors raised while a plan is being built."""


class TransferError(ValueError):
    """A bad argument, class name, path or catalog, found before any job runs."""
