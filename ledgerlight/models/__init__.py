"""Models fitted by distributed passes; what is learned is a handful of numbers."""
