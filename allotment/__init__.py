"""Stock-allocation analytics as plain ``DataFrame -> DataFrame`` functions.

``functions``   column expressions (cleaning, casts, geography, margins)
``operators``   frame operators (cleaning, measures, ranking, control, quality)
``sources``     reading and landing data (tables, JDBC, files) and the sinks
``plans``       the composed flows (Silver tables, the priority index, a full run)
"""
