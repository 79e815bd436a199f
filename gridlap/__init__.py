"""Spark-native analytics for spatial readings taken by robots in laps.

Readings are cleaned and assigned to a lap, averaged per grid cell, rolled up by latest state, lap, day, time of day and hour,
combined to derived observables, and rendered as series and dense matrices. Everything is a ``DataFrame -> DataFrame`` function.
"""
