"""Trade and quote analytics as Spark DataFrame operators.

Every operator is a function from DataFrames to a DataFrame.  Keys, window
lengths and dates are parameters; nothing here opens a session, registers a
view or runs Python in the executors.
"""
