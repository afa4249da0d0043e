"""Default domain settings (taxonomy, rules, reply texts, sample cases).

Every operator takes these as parameters; nothing in the library depends on them.
"""
