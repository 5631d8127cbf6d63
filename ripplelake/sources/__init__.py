"""Inputs: framed lines, message logs, typed messages, stored tables."""
