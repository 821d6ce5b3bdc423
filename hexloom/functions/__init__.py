"""Scalar functions: cell arithmetic, cell encoding, geometry decoding."""
