"""Record layouts of the two event kinds and of the outputs. The field names are fixed by the producers, misspellings included."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names in the order of the records.
TXN_STRINGS = (
    "topic eventId authCode eventTimestamp reqDateTime optId enrolmentReferenceId aua sa asa authResult errorCode subErrorCode authDuration authType "
    "registeredDeviceSoftwareId registeredDeviceSoftwareVersion deviceProviderId modelId deviceCode certExpiryDate faceMatchScore faceMatchType faceSdkVersion "
    "fingerMatchThreshold fmrSDKVersion fingerMatchScore otpIdentifier serverId locationStateCode locationDistrictCode pidSize residentStateCode "
    "residentDistrictCode fmrCount firCount faceUsed fdc idc deviceMetaData fingerFusionPerfomed irisFusionPerfomed faceFusionDone"
).split()
BIO_STRINGS = (
    "topic eventTimestamp eventId optId enrRefId authCode aua bodyPartTypeProbe bioType matchScore probeMinutiae probeSize isLivenessCheckInvoked "
    "livenessRequestInitiatedTime livenessResponseReceivedTime errorCode isLive modalityScore deviceCode islivenessEnabled biolivenessStartTime biolivenessEndtime "
    "faceLivenessScore imageSize imageFormat bioLivenessResponseTime isFaceTemplate faceLivenessClientRequestId isAimlFaceMatcherAllowed isMatched faceMatchScore "
    "faceMatchResponseTime deepPrintRequestId deepPrintFingerPositon deepPrintIsMatched deepPrintFIRMatchScore deepPrintStartTime deepPrintEndTime deepPrintResponseTime"
).split()
CLOCKS = ["kafkaSourceTimestamp", "kafkaSecondSourceTimestamp"]


def _record(strings: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.LongType()) for c in CLOCKS] + [T.StructField(c, T.StringType()) for c in strings])


TXN = _record(TXN_STRINGS)
BIO = _record(BIO_STRINGS)
FEATURE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("entity_id", "feature_id", "feature_name", "feature_version")]
    + [T.StructField("feature_value", T.DoubleType()), T.StructField("timestamp", T.TimestampNTZType()), T.StructField("comments", T.StringType())]
)
FEATURE_KEYS = ["feature_id", "entity_id", "timestamp"]
DEVICE_KEYS = ["opt_id", "previous_devicecode_last_ts"]
