"""Scalar expressions: payload classes, decodings, validators, export forms."""
