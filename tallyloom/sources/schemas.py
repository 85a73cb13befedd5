"""Declared schemas of the input files the operators are meant for."""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


REVIEWS = schema(type=_S, reviewID=_S, overall=_D, verified=_S, reviewTime=_S, reviewerID=_S, asin=_S,
                 reviewerName=_S, reviewText=_S, summary=_S, unixReviewTime=_L, vote=_S, label=_I)
SENTENCES = schema(Sentence=_S, Polarity=_I)
WEALTH = schema(PRCDDA=_I, WSWORTHWPV=_D, WSDEBTB=_D)
DEMOGRAPHY = schema(PRCDDA=_I, STYAPT=_D, STYHOUS=_D, BASPOP=_I, ACTER=_D)
SALES = schema(Product_ID=_I, Import=_I, Num_Retailers=_I, Price=_S, Sales_2016=_D, Sales_2017=_D)
INCOMPLETE = schema(Y=_D, X1=_D, X2=_D, X3=_D, X4=_D, X5=_D)
WINE = schema(Rating=_D, Price=_D, Alcohol=_D, Residual_Sugar=_D, Sulphates=_D, pH=_D, Country=_S)
PARK_SURVEY = T.StructType([T.StructField("weekend", _S), T.StructField("num.child", _I)] + [
    T.StructField(c, _D) for c in ("distance", "rides", "games", "wait", "clean", "overall")])
MARKETING_MIX = schema(sales=_D, price=_D, store=_D, billboard=_D, printout=_D, sat=_D, comp=_D)
BASKETS = schema(Member=_S, SKU=_S, order_merge=_S, Description=_S)
SHOPPERS = schema(Age=_I, Income=_I, SpendingScore=_D, Savings=_D)
