"""Training-data operators: each module holds one operator; ``queries`` registers them.

Nothing outside this package imports it, so the folder can be removed as a whole.
"""
