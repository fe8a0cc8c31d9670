"""``python -m spectrail``."""

from spectrail.cli import main

main()
