"""Errors of the single-account calls; multi-account runs report a status instead."""


class ZeroSalesError(Exception):
    """The account has nothing to report for the range."""


class NoReadyReportError(ValueError):
    """The request log holds no finished report to use."""
