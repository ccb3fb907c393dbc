"""Errors with a cause a caller can act on."""


class NotPositiveDefiniteError(ValueError):
    """A normal-equation or Hessian matrix has no Cholesky factor.

    A constant, duplicated or all-zero feature column is the usual reason.
    """


class DivergedError(ArithmeticError):
    """The loss stopped being a finite number."""
