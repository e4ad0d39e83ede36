"""``python -m lexiquarry``: a run from dumps to results."""

from .plans.run import main

main()
