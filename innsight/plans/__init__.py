"""The questions asked of a cleaned review table, as lazy DataFrame functions.

Each answers for all hotels (cities, nations) in one job; ``hotel=`` and the
like narrow it to one of them by a filter that reaches the scan.
"""
