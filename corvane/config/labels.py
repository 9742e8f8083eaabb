"""Vocabulary of the record-type labels P, I, K and S."""

# Store names by label, in the order in which the lists are tried.
STORES = {
    "P": """DPT LR GMR GMRD TIU OR SRF SRU AUPNVSIT AUPNVCPT AUPNVPRV AUPNVPOV AUPNVHF AUPNVIMM DGPM DGM DGP SCE SDV PSRX PSB DVB NUR
        RADPT RAR FH FHN FHNU IB IBA IBC IBT MAG MCA MCB YS YST BPS FBA DSI GMP""".split(),
    "I": "SC DG ENG PRC HOL".split(),
    "K": "ICD9 ICD0 ICPT ICD LEX PSDRUG PSD AUTTHF AUTTLOC LAM PSR PSNDF PSN ORD ORP ETSRXN PS PSC PSU LAB OCX".split(),
    "S": "XTV XMB XUS DIC DD DI DIE DIA DIPT DIB DDD DDE XPD XT VA QA7 ZRK RG RGED".split(),
}

# Group prefixes by label, in the order in which the lists are tried.
PREFIXES = {
    "P": """DG DPT GMRV GMRD GMRA GMRC GMRE GMRR GMRS TIU OR PSO PSB PSJ PSG PSGM PSW LR LRAD LRAR RA RAAB RAD RAR SR SROA
        SRU SRF PX PXRM DVB DVBA DVBB DVBC NUR NURA SD SDAC SDV FH FHY FHN EC EDP WV WII MHV MHE VEJD VBEC JLV GMPL GMP IB IBA IBC IBD
        IBE IBT IBQ MAG MCA MCB MCE MCF MDC MDD YS YSA YST YTT BPS FBA FB FB5 FB7 ROR DSI DSIR DGM DGP DGT SCE NUP NUPA PTX QAC QAM QAN
        QAO QAP QAR VPR""".split(),
    "I": """DG DGBT A4A7 A4A8 EAS VPS VSIT PRC PRCA PRCN PRCP PRS PRSX ENG EN ENPL RMP RMPC RMPF RMPR RMPS RMI EEO EEOA HOL VAT SOW
        SOWA SOWC PRP PRPF PRPX OOP OOPS""".split(),
    "K": "ICD ICPT LEX PSD PSN PSS PSNDF PSU PSA PSC NLT ETSRXN KLAS ONCZ ONC AUTTHF AUTTLOC AUT OCX LAB LAM LAH LAR RAD".split(),
    "S": """XU XUCS XUS XT XTML XM XMDB XMD DI DIPK XPD XWB XQ XQOR HL HLC HLD HLE HLM HLS XH XHD XOBE XOBS XOBU XOBV XOBW ZT A
        USR QA7 KMP KMPD KMPR XCR XLM XIP XDR RG RGUT RGED ZRK ZMS""".split(),
}

# Words in a record type's name, in the order in which the lists are tried.
NAME_WORDS = {
    "K": "TYPE CATEGORY CLASS CODE DEFINITION TEMPLATE REMINDER".split(),
    "S": "PARAMETER OPTION DEVICE ERROR TASK BULLETIN LOG AUDIT".split(),
    "I": "INSTITUTION FACILITY DIVISION WARD CLINIC SERVICE".split(),
    "P": "PATIENT VISIT ENCOUNTER ADMISSION EPISODE".split(),
}

# What marks a field as sensitive, and prefixes of scratch stores.
SENSITIVE = ["SSN", "SOCIAL SECURITY", "DATE OF BIRTH", "MAIDEN", "MOTHER", "HOME PHONE", "CELL PHONE", "HOME ADDRESS", "STREET"]
SCRATCH = ["TMP", "UTILITY", "XTMP"]
