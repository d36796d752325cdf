"""Scores put into named bands. The limits and names are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_band(score: Column) -> Column:
    return (
        F.when(score >= 8.5, "molto alto")
        .when(score >= 7, "alto")
        .when(score >= 5.5, "medio")
        .when(score.isNotNull(), "basso")
    )


def reputation_trend(delta: Column) -> Column:
    """No change counts as worsening; no recent review is its own case."""
    return F.when(delta.isNull(), "sconosciuta").when(delta > 0, "migliorando").otherwise("peggiorando")


def sentiment_band(score: Column) -> Column:
    return (
        F.when(score < -0.2, "negativo")
        .when(score > 0.2, "positivo")
        .when(score.isNotNull(), "neutrale")
    )


def sentiment_sentence(hotel: Column, score: Column) -> Column:
    verdict = (
        F.when(score < -0.2, "piuttosto negativo 🥵")
        .when(score > 0.2, "piuttosto positivo 😄")
        .otherwise("neutrale 😐")
    )
    return F.concat(F.lit("Il sentiment medio dell'hotel "), hotel, F.lit(" è "), verdict)


def map_bin(sentiment: Column) -> Column:
    return (
        F.when(sentiment.isNull(), "no data")
        .when(sentiment < 0.37, "Sentiment < 0.37")
        .when(sentiment < 0.39, "0.37 <= Sentiment < 0.39")
        .when(sentiment < 0.41, "0.39 <= Sentiment < 0.41")
        .otherwise("Sentiment >= 0.41")
    )


def label_from_score(score: Column, limit: float = 0.05) -> Column:
    """Three-way label of a sentiment score in [-1, 1]."""
    return F.when(score >= limit, "positive").when(score <= -limit, "negative").otherwise("neutral")
